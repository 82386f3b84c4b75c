r"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and of a piece BPE (B) cover the same bytes of a text.

A encodes the text behind a space, B the text itself and adds the space. Both give an array of the byte offsets where their tokens
end. The two arrays are compared along a diagonal: from token i of A and token j of B on, at the shift j - i, the next 8, 16, 32, ...
ends are compared at once as long as all are equal; so a stretch of one-to-one tokens is jumped over in a few comparisons. Where ends
differ, the smaller one moves on until both meet: an irregular group, after which the shift is another. A task does this in many
lanes at once, from places in its texts where both sides end. Places where tokens of both end cut the text into groups; tokens whose
byte ranges overlap are linked.

How many documents hold a pair of ids linked is counted over the whole corpus: a task tells the distinct pairs of its documents,
Spark adds them up. To look the counts up again, the pairs of most documents, HOT_PAIRS at most, are joined by broadcast, all others
by shuffle; a pair so common that it would make one task of that shuffle large is among the first.

A is run by the tiktoken library over the vocabulary of its `tokenizers` file, a merge's rank being its id: the same ids at a
quarter of the time (checked when the file is read: the merges are listed in the order of their ids; and by tests).

Defined cases: texts that are null or empty, or whose joined A or B bytes differ from space and text (B normalises some
characters), have no tokens: all numbers 0 and the digest ''; repeated rows each count as a document; null keys are kept; an
empty table gives an empty result; further columns are returned as they are, but for those named like a result, which are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import text_pieces, texts_of
from lexigauge.sources.scratch import materialize

#: Pairs that are joined by broadcast, at most; text that a task works on at once, or one text.
HOT_PAIRS, PIECE_BYTES = 1_000_000, 500_000
#: Tokens of A from one lane to the next, about; the first and the largest number of ends that are compared at once.
LANE, FIRST, MOST = 256, 8, 256
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable bytes as themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """What is known of a tokenizer's ids: the bytes and their number, and the id's decimal form before each separator."""

    def __init__(self, entries: list[bytes], separators: tuple[str, str]) -> None:
        self.entries = entries
        self.lengths = np.array(list(map(len, entries)), np.int64)
        self.written = np.array([f"{i}{s}" for s in separators for i in range(len(entries))], object)


class Pair:
    """The two tokenizers, loaded once per worker from their files."""

    def __init__(self, path_a: str, path_b: str, pattern: str) -> None:
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocabulary = _byte_of_letter(), model["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        order = [vocabulary[m] for m in merged]
        if any(a >= b for a, b in zip(order, order[1:])):
            raise ValueError(f"the merges in {path_a} are not in the order of their ids")
        ranks = {bytes(letters[c] for c in token): vocabulary[token] for token in [*letters, *merged]}
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            entries[i] = token
        self._a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a = Tokens(entries, (",", "|"))
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [(self._b.id_to_piece(i), self._b.is_byte(i)) for i in range(self._b.get_piece_size())]
        if len(entries) * len(pieces) >= 1 << 32:
            raise ValueError("the vocabularies have too many pairs of ids")
        self.b = Tokens([bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces], (",", ";"))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self._a.encode_ordinary(" " + t) for t in texts], self._b.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str, pattern: str) -> Pair:
    return Pair(path_a, path_b, pattern)


@dataclass(frozen=True)
class Alignment:
    """The ends of the groups as numbers of tokens of A and of B, and the links as places of tokens."""

    ends_a: np.ndarray
    ends_b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray


def _steps(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every stretch."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _lanes(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B at which lanes start: behind a place where both end, looked up behind every LANE-th token of A."""
    near = np.arange(LANE, len(ends_a), LANE)[:, None] + np.arange(LANE // 8)
    near = near[near[:, -1] < len(ends_a) - 1]
    at = np.searchsorted(ends_b, ends_a[near])
    both = ends_b[at] == ends_a[near]
    rows, first = np.flatnonzero(both.any(axis=1)), both.argmax(axis=1)
    return tuple(np.concatenate([[0], x[rows, first[rows]] + 1]) for x in (near, at))


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Two rising arrays of ends with the same last one.

    Many lanes are aligned at once, each at a place of its own; every lane goes on by itself from stretch to group to stretch.
    """
    a, b = (np.concatenate([x, np.full(MOST, y)]) for x, y in ((ends_a, -1), (ends_b, -2)))  # nothing equals what is behind the end
    i, j = _lanes(ends_a, ends_b)
    stop = np.append(i[1:], len(ends_a))
    starts_a, starts_b, lengths, links_a, links_b, met_a, met_b = ([np.zeros(0, np.int64)] for _ in range(7))
    lanes = np.flatnonzero(i < stop)
    while lanes.size:
        begun, block, running = i[lanes], FIRST, lanes
        starts_a.append(begun)
        starts_b.append(j[lanes])
        while running.size:  # the stretch at the shift j - i
            places = np.arange(block)
            same = a[i[running][:, None] + places] == b[j[running][:, None] + places]
            whole = same.all(axis=1)
            length = np.minimum(np.where(whole, block, same.argmin(axis=1)), stop[running] - i[running])
            i[running] += length
            j[running] += length
            running = running[whole & (i[running] < stop[running])]
            block = min(2 * block, MOST)
        lengths.append(i[lanes] - begun)
        apart = lanes = lanes[i[lanes] < stop[lanes]]
        while apart.size:  # the irregular group
            at_a, at_b = i[apart], j[apart]
            end_a, end_b = a[at_a], b[at_b]
            links_a.append(at_a)
            links_b.append(at_b)
            i[apart] += end_a <= end_b
            j[apart] += end_b <= end_a
            met = end_a == end_b
            met_a.append(at_a[met] + 1)
            met_b.append(at_b[met] + 1)
            apart = apart[~met]
        lanes = lanes[i[lanes] < stop[lanes]]
    starts_a, starts_b, lengths, links_a, links_b, met_a, met_b = map(np.concatenate, (starts_a, starts_b, lengths, links_a, links_b, met_a, met_b))
    one_a, one_b = _steps(starts_a, lengths), _steps(starts_b, lengths)
    return Alignment(
        np.sort(np.concatenate([one_a + 1, met_a])), np.sort(np.concatenate([one_b + 1, met_b])),
        np.concatenate([one_a, links_a]), np.concatenate([one_b, links_b]),
    )


def written_groups(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> np.ndarray:
    """Ids with their separators, group by group: ids of A, a bar, ids of B, a semicolon."""
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[found.ends_a - 1], last_b[found.ends_b - 1] = len(pair.a.entries), len(pair.b.entries)
    # A group's tokens of A stand behind all tokens of earlier groups, those of B behind its own ones of A.
    before_b = np.concatenate([[0], found.ends_b[:-1]])
    out = np.empty(len(ids_a) + len(ids_b), object)
    sizes_a, sizes_b = np.diff(found.ends_a, prepend=0), np.diff(found.ends_b, prepend=0)
    out[np.arange(len(ids_a)) + np.repeat(before_b, sizes_a)] = pair.a.written[ids_a + last_a]
    out[np.arange(len(ids_b)) + np.repeat(found.ends_a, sizes_b)] = pair.b.written[ids_b + last_b]
    return out


def _whole(tokens: Tokens, ids: np.ndarray, sizes: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """For each text, whether the bytes of its ids are a space and the text."""
    ends = np.concatenate([[0], np.cumsum(tokens.lengths[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
    made = b"".join(map(tokens.entries.__getitem__, ids.tolist()))
    if made == b"".join(x for t in texts for x in (b" ", t)) and np.array_equal(np.diff(ends), np.array(list(map(len, texts))) + 1):
        return np.ones(len(texts), bool)
    return np.array([made[x:y] == b" " + t for x, y, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts, strict=True)], bool)


def linked(pair: Pair, texts: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text (n_a, n_b, n_groups, n_links) and the digest of its groups; where the pairs of a text end, all distinct linked pairs
    of ids, text by text, and their numbers of links.

    All texts are aligned as one: each ends where tokens of both sides end.
    """
    encoded = pair.encode([t.decode() for t in texts])
    sizes = [np.array(list(map(len, side)), np.int64) for side in encoded]
    ids = [np.fromiter(chain.from_iterable(side), np.int64) for side in encoded]
    good = np.array(list(map(bool, texts)), bool)
    for tokens, side, size in zip((pair.a, pair.b), ids, sizes, strict=True):
        good &= _whole(tokens, side, size, texts)
    kept = np.flatnonzero(good)
    numbers, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
    if not len(kept):
        return numbers, digests, np.zeros(len(texts), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids_a, ids_b = (side[np.repeat(good, size)] for side, size in zip(ids, sizes, strict=True))
    sizes_a, sizes_b = (size[kept] for size in sizes)
    found = align(np.cumsum(pair.a.lengths[ids_a]), np.cumsum(pair.b.lengths[ids_b]))
    tokens_a = np.cumsum(sizes_a)
    groups = np.diff(np.searchsorted(found.ends_a, tokens_a, side="right"), prepend=0)
    text = np.repeat(kept, sizes_a)[found.links_a]
    numbers[kept] = np.column_stack([sizes_a, sizes_b, groups, np.bincount(text, minlength=len(texts))[kept]])
    words, first = written_groups(pair, ids_a, ids_b, found).tolist(), 0
    for i, last in zip(kept.tolist(), np.cumsum(sizes_a + sizes_b).tolist(), strict=True):
        digests[i] = hashlib.sha256("".join(words[first:last])[:-1].encode()).hexdigest()
        first = last
    # Both numbers of a pair are below 2 ** 32 together, as a piece's texts are.
    codes, links = np.unique(text << 32 | ids_a[found.links_a] * len(pair.b.entries) + ids_b[found.links_b], return_counts=True)
    return numbers, digests, np.searchsorted(codes >> 32, np.arange(len(texts)), side="right"), codes & 0xFFFFFFFF, links


def _aligned(docs: DataFrame, text: str, kept: list[str], paths: tuple[str, str], pattern: str) -> DataFrame:
    """`kept` with the numbers and digests of each document, its distinct pairs and their links."""
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([
        *[docs.schema[c] for c in kept], *[T.StructField(n, T.LongType()) for n in numbers], T.StructField("groups_sha256", T.StringType()),
        T.StructField("_xt_pairs", T.ArrayType(T.LongType())), T.StructField("_xt_links", T.ArrayType(T.LongType())),
    ])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(*paths, pattern)
        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                counts, digests, ends, pairs, links = linked(pair, texts_of(part, text))
                ends = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                columns = [
                    *[part[c] for c in kept], *[pa.array(n) for n in counts.T.copy()], pa.array(digests, pa.string()),
                    *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in (pairs, links)],
                ]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, n_ids_b: int) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether no pair of its A id is in more."""
    counts = aligned.select(F.explode("_xt_pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    counts = materialize(counts.withColumn("a", F.expr(f"pair div {n_ids_b}")), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _common(counts: DataFrame, hot_pairs: int) -> int:
    """The least power of two from which on there are at most `hot_pairs` pairs of such counts."""
    power = F.floor(F.log2(F.col("count"))).cast("int")
    rows = sorted(map(tuple, counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()))  # 64 rows at most
    least = 1 << 62
    for p, n in reversed(rows):
        hot_pairs -= n
        if hot_pairs < 0:
            break
        least = 1 << p
    return least


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, pattern: str, text: str = "text", keep: list[str] | None = None, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """`keep` (all columns, if None) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    n_ids_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = _aligned(docs, text, kept, (path_a, path_b), pattern).withColumn("_xt_row", F.monotonically_increasing_id())
    aligned = materialize(aligned, "aligned")
    counts = materialize(pair_counts(aligned, n_ids_b), "counts")
    common = _common(counts, hot_pairs)
    hot, rare = counts.filter(F.col("count") >= common), counts.filter(F.col("count") < common)
    asked = aligned.select("_xt_row", F.inline(F.arrays_zip("_xt_pairs", "_xt_links")).alias("pair", "links"))
    told = asked.join(F.broadcast(hot), "pair")
    if common > 1:
        told = told.unionByName(asked.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(rare, "pair"))
    sums = told.groupBy("_xt_row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum")
    )
    return aligned.drop("_xt_pairs", "_xt_links").join(sums, "_xt_row", "left").select(
        *kept, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
