r"""Language identification by interpolated Kneser-Ney models of characters, one per language.

A text is read as its letters and marks in lower case, everything else as one space. A model gives the probability of every
character, and of the space that ends a word, after the three characters before it; what precedes the word's first letter does not
count, so a word is judged alike wherever it stands and no string reaches from one text into the next. Four characters back off to
three, two and one by absolute discounting; the lower orders count in how many contexts a string occurs, as Kneser and Ney do. The
discounts follow from how many strings occur once and twice, per language and order.

Strings of four characters are 64-bit hashes: sixteen bits a character, the code point itself in the basic plane and a hash of it
beyond, so the strings and contexts of lower orders are shifts of the same number. Counts, contexts and discounts are tables in the
shared folder, made by Spark from all training rows; they grow with the corpus. For scoring they become sorted hash arrays with a
column per language, dealt into blocks by the character before the last (all orders of a string share it), so that no more than
BLOCK_BYTES are broadcast at once, or the hashes of one such character. Usually there is one block. With more, documents pass once per
block and the sums so far go on with them.

A document gets the language with the lowest cross-entropy per character. Its score is the chance that this is right, by a logistic
curve over the margin to the second language, fitted to a histogram of all training rows. `accepted` is false where the cross-entropy
is above nearly all (1 - `reject`) of the training rows of that language: such a text is likely in none of the learned languages.

Defined cases: null texts and texts without a letter are `und` with score 0 and are not accepted; without training rows all texts
are; with one language its margin counts as the widest; equal cross-entropies go to the alphabetically first; rows without a
language, and those that `train` leaves out (or is null for), teach nothing; repeated rows each count and are scored alike;
further columns are returned as they are, but for those named `lang_pred`, `score` or `accepted`, which are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import PIECE_BYTES, give_back, text_pieces, texts_of
from lexigauge.sources.scratch import materialize

ORDER = 4
UNKNOWN = "und"
BLOCK_BYTES = 64_000_000
#: Text that a task counts before it hands on its counts.
COUNTED_BYTES = 2_000_000
#: Least share of training rows of a language that `accepted` refuses; width and number of the margins' bins.
REJECT, BIN, BINS = 0.001, 0.02, 200
#: More distinct values are no languages: a model has a column for each.
MAX_LANGUAGES = 5_000
_MASKS = {k: (1 << 16 * k) - 1 for k in (1, 2, 3)}


@dataclass(frozen=True)
class Model:
    """The learned languages in order; (`order`, `hash`, `language`, `value`) in the shared folder; blocks of characters.

    Orders 4 to 1 hold what a string has of its context's count after the discount, orders -3 to -1 the share that a context leaves to
    the next lower order. `floor`: per language the share that order 1 leaves to all characters alike.
    """

    languages: list[str]
    table: DataFrame | None
    blocks: list[np.ndarray]
    floor: np.ndarray
    curve: np.ndarray
    limits: np.ndarray


@cache
def _characters() -> np.ndarray:
    """The 16-bit code of every code point: 0 for all that is neither letter nor mark."""
    codes = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        if unicodedata.category(chr(point))[0] in "LM":
            low = chr(point).lower()
            value = ord(low[0])  # a lower case of several characters stands for its first
            codes[point] = value if value < 0x10000 else max((value * 0x9E3779B1 >> 8) & 0xFFFF, 1)
    return codes


@cache
def _is_letter() -> np.ndarray:
    return np.array([unicodedata.category(chr(p))[0] == "L" for p in range(0x110000)])


def characters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of texts as codes with one 0 behind every word; where each text ends there; whether it has a letter."""
    wide = [np.frombuffer(t.decode().encode("utf-32-le"), np.uint32) for t in texts]
    points = np.concatenate([x for t in wide for x in (t, np.zeros(1, np.uint32))]) if wide else np.zeros(0, np.uint32)
    ends = np.cumsum([len(t) + 1 for t in wide])
    codes = _characters()[points]
    kept = codes != 0
    kept[1:] |= codes[:-1] != 0  # of several spaces the first stays
    letters = np.concatenate([[0], np.cumsum(_is_letter()[points])])[np.concatenate([[0], ends])]
    return codes[kept], np.concatenate([[0], np.cumsum(kept)])[ends] if wide else np.zeros(0, np.int64), np.diff(letters) > 0


def strings_of(codes: np.ndarray) -> np.ndarray:
    """The hash of each character and the three before it; those before a word's first letter are 0."""
    out = codes.astype(np.uint64)
    inside = np.ones(len(codes), bool)  # whether nothing but letters lies between
    for back in range(1, ORDER):
        before = np.zeros(len(codes), np.uint64)
        before[back:] = codes[:-back]
        inside &= before != 0
        out |= np.where(inside, before, 0).astype(np.uint64) << np.uint64(16 * back)
    return out.view(np.int64)


def count_strings(docs: DataFrame, text: str, language: str) -> DataFrame:
    """(language, hash, n) of strings of four characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for name in list(held):
                found = pc.value_counts(pa.array(strings_of(characters(held.pop(name))[0])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), found.field(0), found.field(1)], names=["language", "hash", "n"]
                )

        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                for body, name in zip(texts_of(part, text), part.column(part.schema.get_field_index(language)).to_pylist(), strict=True):
                    held.setdefault(name, []).append(body)
                    size += len(body)
                if size >= COUNTED_BYTES:
                    yield from counted()
                    size = 0
        yield from counted()
        give_back()

    part = docs.select(text, language).mapInArrow(run, "language string, hash long, n long")
    return part.groupBy("language", "hash").agg(F.sum("n").alias("n"))


def _low(order: int) -> Column:
    return F.col("hash").bitwiseAND(F.lit(_MASKS[order]))


def _orders(counts: DataFrame) -> dict[int, DataFrame]:
    """Per order (language, hash, n), written: counts of strings, below the highest order those of their contexts.

    A string that starts a word has one context only and keeps its count, as usual.
    """
    out = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        low = _low(order)
        starts = F.shiftright(low, 16 * (order - 1)).bitwiseAND(F.lit(0xFFFF)) == 0
        seen = F.lit(1) if order == 1 else F.when(starts, F.col("n")).otherwise(1)
        parts = out[order + 1].select("language", low.alias("hash"), seen.alias("n"))
        out[order] = materialize(parts.groupBy("language", "hash").agg(F.sum("n").alias("n")), f"order{order}")
    return out


def _entries(counts: dict[int, DataFrame]) -> DataFrame:
    """(order, language, hash, value) of all orders. Discounts are n1 / (n1 + 2 n2) of their order and language.

    What stands in one context, at most one string per character, meets in one row and is laid out again.
    """
    parts = []
    for order, table in counts.items():
        once = table.groupBy("language").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        cut = F.least(F.greatest(F.col("n1") / (F.col("n1") + 2 * F.col("n2")), F.lit(0.1)), F.lit(0.9))
        cuts = once.select("language", F.coalesce(F.when(F.col("n1") > 0, cut), F.lit(0.5)).alias("cut"))  # a row per language
        met = table.groupBy("language", F.shiftrightunsigned("hash", 16).alias("context")).agg(
            F.sum("n").alias("total"), F.collect_list(F.struct("hash", "n")).alias("strings")
        )
        entry = lambda k, hashes, value: F.struct(F.lit(k).alias("order"), hashes.alias("hash"), value.alias("value"))
        left = entry(1 - order, F.col("context"), F.size("strings") * F.col("cut") / F.col("total"))
        own = F.transform("strings", lambda s: entry(order, s["hash"], (s["n"] - F.col("cut")) / F.col("total")))  # noqa: B023
        parts.append(met.join(F.broadcast(cuts), "language").select("language", F.inline(F.concat(F.array(left), own))))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select("order", "language", "hash", "value")


def _before_last(order: Column, hashes: Column) -> Column:
    """The character that deals an entry to a block; null for those that every block needs."""
    character = F.when(order > 1, F.shiftright(hashes, 16)).when(order < 0, hashes)
    return character.bitwiseAND(F.lit(0xFFFF))


def _blocks(table: DataFrame, n_languages: int, block_bytes: int) -> list[np.ndarray]:
    """Runs of characters whose entries stay below `block_bytes`; a row per character comes to the driver, 65,536 at most."""
    sized = table.groupBy(_before_last(F.col("order"), F.col("hash")).alias("c")).agg(F.count_distinct("order", "hash").alias("n"))
    rows = sorted((r["c"], r["n"] * (8 + 4 * n_languages)) for r in sized.collect() if r["c"] is not None)
    blocks, size = [[]], 0
    for character, weight in rows:
        if blocks[-1] and size + weight > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append(character)
        size += weight
    out = [np.zeros(1 << 16, bool) for _ in blocks]
    for at, block in zip(out, blocks, strict=True):
        at[block] = True
    out[0] |= ~np.logical_or.reduce(out)  # characters never seen before another one
    return out


class Arrays:
    """A block of the model: per order the sorted hashes and a row of values for each, with the default in the last row."""

    def __init__(self, rows: pa.Table, n_languages: int, floor: np.ndarray) -> None:
        order, hashes = (rows[c].to_numpy() for c in ("order", "hash"))
        language, value = (rows[c].to_numpy() for c in ("language", "value"))
        self.keys: dict[int, np.ndarray] = {}
        self.values: dict[int, np.ndarray] = {}
        self.floor = floor
        for k in [*range(1 - ORDER, 0), *range(1, ORDER + 1)]:
            at = order == k
            keys, place = np.unique(hashes[at], return_inverse=True)
            values = np.full((len(keys) + 1, n_languages), 0 if k > 0 else 1, np.float32)
            values[place, language[at]] = value[at]
            self.keys[k], self.values[k] = keys, values

    def _at(self, order: int, hashes: np.ndarray) -> np.ndarray:
        keys, values = self.keys[order], self.values[order]
        if not len(keys):
            return values[np.zeros(len(hashes), np.int64)]
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return values[np.where(keys[place] == hashes, place, len(keys))]

    def costs(self, strings: np.ndarray) -> np.ndarray:
        """-log of the probability of each string's last character after the others, a column per language."""
        share = self._at(1, strings & _MASKS[1]) + self.floor
        for order in range(2, ORDER + 1):
            low = strings & _MASKS[order] if order < ORDER else strings
            context = (low.view(np.uint64) >> np.uint64(16)).view(np.int64)
            share = self._at(order, low) + self._at(1 - order, context) * share
        return -np.log(share)


def text_costs(arrays: Arrays, inside: np.ndarray, texts: list[bytes], n_languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the sum of costs of its strings in this block, its number of characters, and whether it has a letter."""
    codes, ends, lettered = characters(texts)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    found = pa.array(strings_of(codes)).dictionary_encode()
    strings, place = found.dictionary.to_numpy(), found.indices.to_numpy()
    costs = np.zeros((n_languages, len(strings)))
    here = inside[(strings >> 16) & 0xFFFF]
    costs[:, here] = arrays.costs(strings[here]).T
    text = np.repeat(np.arange(len(texts)), ends - starts)
    # Added up in order within each text, so a sum does not depend on what stands beside it.
    return np.column_stack([np.bincount(text, row[place], len(texts)) for row in costs]), ends - starts, lettered


def _summed(docs: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """`keep` of docs with `_lid_sums` (an array, null without letters) and `_lid_n`."""
    spark = docs.sparkSession
    n_languages, frame = len(model.languages), docs.select(*dict.fromkeys([*keep, text])).withColumn("_lid_sums", F.lit(None).cast("array<double>"))
    for number, inside in enumerate(model.blocks):
        frame, last = frame.drop("_lid_n"), number == len(model.blocks) - 1
        names = keep if last else [c for c in frame.columns if c != "_lid_sums"]
        fields = [frame.schema[c] for c in names]
        schema = T.StructType([*fields, T.StructField("_lid_sums", T.ArrayType(T.DoubleType())), T.StructField("_lid_n", T.LongType())])
        characters_here = F.broadcast(spark.createDataFrame([(int(c),) for c in np.flatnonzero(inside)], "_lid_c int"))
        table = model.table.withColumn("_lid_c", _before_last(F.col("order"), F.col("hash")).cast("int"))
        rows = table if len(model.blocks) == 1 else table.filter("_lid_c IS NULL").unionByName(table.join(characters_here, "_lid_c", "left_semi"))
        shared = spark.sparkContext.broadcast((Arrays(rows.drop("_lid_c").toArrow(), n_languages, model.floor), inside))
        frame = _pass(frame, text, names, schema, shared, n_languages)
        if not last:
            frame = materialize(frame, "summed")
    return frame


def _pass(frame: DataFrame, text: str, names: list[str], schema: T.StructType, shared, n_languages: int) -> DataFrame:
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, inside = shared.value
        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                sums, n, lettered = text_costs(arrays, inside, texts_of(part, text), n_languages)
                before = part["_lid_sums"].to_pylist()
                new = [None if not ok else (row if b is None else row + np.array(b)) for row, b, ok in zip(sums, before, lettered, strict=True)]
                columns = [*[part[c] for c in names], pa.array(new, pa.list_(pa.float64())), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)
        give_back()

    return frame.mapInArrow(run, schema)


def _judged(summed: DataFrame, languages: list[str]) -> DataFrame:
    """`summed` with `_lid_best` (number of the language), `_lid_cost` of it and `_lid_margin` to the second one, per character."""
    numbered = F.array_sort(F.transform("_lid_sums", lambda s, i: F.struct((s / F.col("_lid_n")).alias("cost"), i.alias("at"))))
    first, second = (F.get(F.col("_lid_order"), i) for i in (0, 1))
    margin = F.coalesce(second["cost"] - first["cost"], F.lit(BIN * BINS))
    return summed.withColumn("_lid_order", numbered).select(
        *[c for c in summed.columns if c not in ("_lid_sums", "_lid_n")], first["at"].alias("_lid_best"), first["cost"].alias("_lid_cost"),
        F.when(first.isNotNull(), margin).alias("_lid_margin"),
    )


def _curve(bins: list[tuple[int, int, int]]) -> np.ndarray:
    """Logistic curve over the margin, from (bin, rows, right rows).

    Two rows are added to either end: one of two is right without a margin, both at the widest. Newton steps with a small ridge.
    """
    x = np.array([0.0, BIN * BINS, *[(b + 0.5) * BIN for b, _, _ in bins]])
    n = np.array([2.0, 2.0, *[n for _, n, _ in bins]])
    right = np.array([1.0, 2.0, *[r for _, _, r in bins]])
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-3])
        step = np.linalg.solve(slope, design.T @ (right - n * p) - np.array([1e-6, 1e-3]) * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _training(docs: DataFrame, text: str, language: str, train: Column) -> DataFrame:
    return docs.filter(F.col(language).isNotNull() & F.col(text).isNotNull() & F.coalesce(train, F.lit(False)))


def fit(docs: DataFrame, text: str = "text", language: str = "lang", train: Column | None = None, block_bytes: int = BLOCK_BYTES) -> Model:
    """Count the strings of all training rows. `train` tells which rows may teach (all with a language, if None)."""
    rows = _training(docs, text, language, F.lit(True) if train is None else train).select(
        F.col(text).alias("text"), F.col(language).cast("string").alias("language")
    )
    strings = materialize(count_strings(rows, "text", "language"), "strings")
    languages = [r[0] for r in strings.select("language").distinct().orderBy("language").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"column {language} has more than {MAX_LANGUAGES} values")
    if not languages:
        return Model([], None, [], np.zeros(0), np.zeros(2), np.zeros(0))
    counts = _orders(strings)
    characters_seen = counts[1].agg(F.count_distinct("hash")).first()[0]
    named = materialize(_entries(counts), "entries")
    numbers = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(languages)), "number int, language string"))
    numbered = named.join(numbers, "language")
    # Order 1 has one context, the empty one: what it leaves is shared by all characters and one never seen.
    floor = np.zeros(len(languages), np.float32)
    for r in numbered.filter("order = 0").collect():
        floor[r["number"]] = r["value"] / (characters_seen + 1)
    table = materialize(numbered.filter("order != 0").select("order", "hash", F.col("number").alias("language"), F.col("value").cast("float")), "model")
    return Model(languages, table, _blocks(table, len(languages), block_bytes), floor, np.zeros(2), np.full(len(languages), np.inf))


def calibrate(judged: DataFrame, model: Model, language: str, train: Column, reject: float = REJECT) -> Model:
    """`model` with the curve and the limits that the training rows among `judged` give."""
    known = judged.filter(F.col(language).isNotNull() & F.col("_lid_best").isNotNull() & F.coalesce(train, F.lit(False)))
    name = F.get(F.array(*map(F.lit, model.languages)), F.col("_lid_best"))
    at = F.least(F.floor(F.col("_lid_margin") / BIN), F.lit(BINS - 1)).cast("int")
    bins = known.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.count_if(name == F.col(language).cast("string")).alias("r"))
    curve = _curve([tuple(r) for r in bins.orderBy("b").collect()])  # BINS rows at most
    limits = np.full(len(model.languages), np.inf)
    own = known.filter(name == F.col(language).cast("string"))
    for r in own.groupBy("_lid_best").agg(F.percentile_approx("_lid_cost", 1 - reject, 10_000).alias("q")).collect():  # a row per language
        limits[r["_lid_best"]] = r["q"]
    return Model(model.languages, model.table, model.blocks, model.floor, curve, limits)


def identify(
    docs: DataFrame, text: str = "text", language: str = "lang", train: Column | None = None, keep: list[str] | None = None,
    reject: float = REJECT, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Learn from the training rows of `docs`, then add `lang_pred`, `score` and `accepted` to all rows (their columns `keep`)."""
    named = ("lang_pred", "score", "accepted")
    wanted = [c for c in (docs.columns if keep is None else keep) if c not in named]
    teaches = F.lit(True) if train is None else train
    model = fit(docs, text, language, teaches, block_bytes)
    if not model.languages:
        return docs.select(*wanted, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    marked = docs.withColumn("_lid_language", F.col(language).cast("string")).withColumn("_lid_train", F.coalesce(teaches, F.lit(False)))
    judged = materialize(_judged(_summed(marked, model, text, [*wanted, "_lid_language", "_lid_train"]), model.languages), "judged")
    model = calibrate(judged, model, "_lid_language", F.col("_lid_train"), reject)
    return _told(judged, model, wanted)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with `lang_pred`, `score` and `accepted` by a calibrated model."""
    wanted = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "accepted")]
    if not model.languages:
        return docs.select(*wanted, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    return _told(_judged(_summed(docs, model, text, wanted), model.languages), model, wanted)


def _told(judged: DataFrame, model: Model, wanted: list[str]) -> DataFrame:
    best = F.col("_lid_best")
    name = F.get(F.array(*map(F.lit, model.languages)), best)
    limit = F.get(F.array(*[F.lit(float(x)) for x in model.limits]), best)
    chance = 1 / (1 + F.exp(-(float(model.curve[0]) + float(model.curve[1]) * F.col("_lid_margin"))))
    return judged.select(
        *wanted, F.coalesce(name, F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(chance, F.lit(0.0)).alias("score"),
        F.coalesce(F.col("_lid_cost") <= limit, F.lit(False)).alias("accepted"),
    )
