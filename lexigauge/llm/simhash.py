"""SimHash near duplicates: fingerprints of word shingles, linked where few bits differ.

Meet-in-the-middle ball hashing. Two fingerprints at distance 1 or 2 meet in a variant that is within one bit of both. At
distance 3 one of them has an odd number of set bits and the other an even one, and two of the three bits lie in the same half
of the word: the odd one meets the even one's one-bit variant after flipping those two. So every fingerprint emits itself and
its 64 one-bit variants as a centre, and every odd one also its 992 variants with two bits of one half flipped as a guest.

All centres of a variant are within two bits of each other and each guest is within three bits of each centre. Linking all of
them to the smallest centre therefore connects exactly what is linked, without listing the pairs of a crowded variant, and each
link is verified. Only distinct fingerprints take part; copies cost nothing.

Variants are shuffled in two steps: a row per fingerprint and reachable value of 24 of the bits; the other flips are made
behind the shuffle, where rows with equal 24 bits already share a task. That moves about a sixth of the rows.

Connected components come from alternating steps (every vertex links its larger, then its smaller neighbours to the least
one) over the links alone, each round written to the shared folder.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; equal rows are all returned; a null
key never names a component but its row belongs to one (null if no member has a key); an empty table gives an empty result; further columns are
returned as they are, but for those named `fingerprint` or `component_id`, which are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lexigauge.llm.batches import add_columns
from lexigauge.sources.scratch import materialize

SHINGLE, SEED, MAX_BITS = 3, 42, 3
PRINTS_PER_TASK = 3000
HALVES = (tuple(range(32)), tuple(range(32, 64)))
#: Bits whose flips are made before the shuffle, twelve of each half; the others are flipped behind it.
KEY = (tuple(range(12)), tuple(range(32, 44)))
REST = tuple(tuple(b for b in half if b not in key) for half, key in zip(HALVES, KEY, strict=True))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(*bits: int) -> int:
    return _signed(sum(1 << b for b in bits))


KEY_MASK = _mask(*KEY[0], *KEY[1])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if more than half of the shingles' hashes have it. Words are runs without ASCII white space, A-Z lowered."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    whole = n // 255 * 255
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def add_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """Add `fingerprint`, a long with the 64 bits."""
    return add_columns(
        docs, text, [("fingerprint", T.LongType())], lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.int64)], keep
    )


def hex_of(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _array(masks) -> Column:
    return F.array(*[F.lit(m) for m in masks])


# Kinds of rows in the shuffle, and the flips of other bits that each still makes behind it.
_BEHIND = {
    0: [0, *[_mask(b) for b in REST[0] + REST[1]]],  # centre, no bit flipped yet
    1: [0],  # centre, one bit flipped; guest, two bits flipped
    2: [_mask(*p) for half in REST for p in combinations(half, 2)],  # guest, no bit flipped yet
    3: [_mask(b) for b in REST[0]],  # guest, one bit of the first half flipped
    4: [_mask(b) for b in REST[1]],
}
_CENTRES = [(0, 0, True), *[(_mask(b), 1, True) for key in KEY for b in key]]
_GUESTS = [
    (0, 2, False), *[(_mask(b), 3 + i, False) for i, key in enumerate(KEY) for b in key],
    *[(_mask(*p), 1, False) for key in KEY for p in combinations(key, 2)],
]


def _structs(rows) -> Column:
    return F.array(*[F.struct(F.lit(m).alias("flip"), F.lit(k).alias("kind"), F.lit(c).alias("centre")) for m, k, c in rows])


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: links that connect exactly the fingerprints at most three bits apart. `prints`: distinct `fingerprint`s."""
    odd = F.bit_count("fingerprint") % 2 == 1
    sent = prints.select(
        "fingerprint", F.inline(F.when(odd, _structs([*_CENTRES, *_GUESTS])).otherwise(_structs(_CENTRES)))
    ).select("fingerprint", "kind", "centre", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("near"))
    sent = sent.withColumn("part", F.col("near").bitwiseAND(F.lit(KEY_MASK)))
    # Behind the shuffle a fingerprint has some 500 rows, which a task sorts.
    n = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-prints.count() // PRINTS_PER_TASK))
    flips = F.when(F.col("kind") == 0, _array(_BEHIND[0]))
    for kind in (1, 2, 3, 4):
        flips = flips.when(F.col("kind") == kind, _array(_BEHIND[kind]))
    met = sent.repartition(n, "part").select("part", "fingerprint", "centre", "near", F.explode(flips).alias("flip"))
    met = met.select("part", "fingerprint", "centre", F.col("near").bitwiseXOR(F.col("flip")).alias("variant"))
    star = "min(CASE WHEN centre THEN fingerprint END) OVER (PARTITION BY part, variant)"
    pairs = met.withColumn("hub", F.expr(star)).filter("hub IS NOT NULL AND hub != fingerprint")
    near = F.bit_count(F.col("hub").bitwiseXOR(F.col("fingerprint"))) <= MAX_BITS
    return pairs.filter(near).select(F.least("hub", "fingerprint").alias("a"), F.greatest("hub", "fingerprint").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of `edges` (a, b): root is the least vertex of its component.

    Each round links, for every vertex, first its larger and then its smaller neighbours to the least of them all. The edges
    of a vertex are never gathered: the least neighbour is an aggregate that is joined back.
    """
    edges = materialize(edges, "edges")
    while True:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        large = both.filter("u > v").join(least, "v").select(F.col("m").alias("a"), F.col("u").alias("b")).filter("a < b").distinct()
        large = materialize(large, "large")
        lowest = large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("m"))
        kept = large.select(F.col("b").alias("v"), F.col("a").alias("u")).join(lowest, "v").select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("u").alias("b")), F.struct(F.col("m").alias("a"), F.col("v").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a < b").distinct()
        kept = materialize(kept, "edges")
        if _same(edges, kept):
            return kept.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root"))
        edges = kept


def _same(one: DataFrame, other: DataFrame) -> bool:
    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())

    return digest(one) == digest(other)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, shingle: int = SHINGLE, root: str | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `fingerprint` and `component_id`, the least key among the documents reachable by links.

    `root` names a further column, if given: the least fingerprint of the component, which it has without keys too.
    """
    columns = list(dict.fromkeys([key, *(docs.columns if keep is None else keep)]))
    rows = materialize(add_fingerprint(docs, text, shingle, columns), "fingerprints")
    prints = materialize(rows.groupBy("fingerprint").agg(F.min(key).alias("_least")), "prints")
    roots = components(links(prints.select("fingerprint")))
    rooted = prints.join(roots.withColumnRenamed("v", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    further = [] if root is None else [F.col("root").alias(root)]
    named = materialize(rooted.join(least, "root").select("fingerprint", "component_id", *further), "components")
    return rows.drop("component_id").join(named, "fingerprint").select(
        *[c for c in columns if c not in ("fingerprint", "component_id")], "fingerprint", "component_id", *([] if root is None else [root])
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One document of each component: that with the least key (of rows with one key, that with the least hash of all columns).

    Documents without a key count as larger than any. Texts are shuffled once, to meet the keys that stay.
    """
    held = docs.withColumn("_row", F.xxhash64(*docs.columns))
    known = near_duplicates(held, text, key, ["_row"], shingle, "_root")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row"))
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("f"), F.col("_root").cast("string")))
    first = known.select(group.alias("_group"), F.col("component_id"), order.alias("o")).filter(
        "component_id IS NULL OR o.key = component_id"
    ).groupBy("_group").agg(F.min("o").alias("o"))
    stay = materialize(first.select(F.col("o.key").alias("_key"), F.col("o.row").alias("_row")), "stay")
    met = held.join(stay, held[key].eqNullSafe(stay["_key"]) & (held["_row"] == stay["_row"]), "left_semi")
    return met.selectExpr("*", f"row_number() OVER (PARTITION BY `{key}`, _row ORDER BY 1) AS _copy").filter("_copy = 1").drop("_row", "_copy")
