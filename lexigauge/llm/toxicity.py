"""Toxicity by two Kneser-Ney models, one per class.

The labelled documents give two models of the next byte, of the toxic and of the ordinary class: six bytes back off to four
(counted by how many six-byte strings end in them, as Kneser and Ney do), and these to one distribution of two bytes that both
classes share. Counts are discounted first, so an expression seen rarely leaves its mass to the shared counts and says the
same in both classes. Bytes and not words, since many toxic expressions occur once only but share a stem.
A document is scored by the log-likelihood ratio of its bytes, normalised by length: over the whole text and over its best
windows. A logistic curve turns these into a score. It is fitted to some labelled documents by the counts of all the others;
then the strings of those documents are added to the counts.

All labelled documents are counted, each six-byte string for itself: the model is a table of exact counts
that grows with the corpus and is never gathered. All counts behind a string share its three middle bytes (its five-byte
context, its four-byte ending and the context of that), so the table is dealt into buckets by these bytes, each of which
scores its strings alone. Documents are dealt into chunks; a chunk asks every bucket once for its distinct strings.

Defined cases: null and empty texts, and texts without words, have ratio zero and get the score of that; without toxic or
without ordinary training documents every score is 0; several label rows of a document count as one with the largest label;
null keys and null labels teach nothing; repeated rows are scored alike and each counts; further columns are returned as they
are, but for those named `score` or `predicted`, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import PIECE_BYTES, give_back, plain, text_pieces, texts_of
from lexigauge.sources.scratch import materialize

#: Bytes per string of the upper and the lower order; bits of the filter of keys.
UPPER, LOWER = 6, 4
FILTER_BITS = 26
#: Labelled documents that fit the curve, at most: those with the smallest hashes in one of SLICES slices.
CURVE_ROWS, SLICES = 4000, 8
WINDOWS = (8, 24, 64)
DISCOUNT = 1
THRESHOLD = 0.3
_CHUNK, _PIECE = 4_000_000, 500_000
#: Bytes of text in a chunk and per bucket, strings of the model per bucket.
CHUNK_BYTES, BUCKET_BYTES, BUCKET_STRINGS = 32_000_000, 64_000_000, 250_000


class Lookup:
    """Rows of `values` by their sorted `keys`; `other` for any other key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, other: list[float]) -> None:
        self.keys, self.values = keys, np.concatenate([values, [other]]).astype(np.float32)

    def __getitem__(self, at: np.ndarray | int | tuple) -> np.ndarray:
        if isinstance(at, tuple):
            return self[at[0]][..., at[1]]
        if not len(self.keys):
            return self.values[np.full(np.shape(at), -1)]
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return self.values[np.where(self.keys[place] == at, place, -1)]


@dataclass(frozen=True)
class Tables:
    """What some strings and their counts say, with a column per class (0 ordinary, 1 toxic); `shared` by the last two bytes."""

    upper: Lookup
    upper_left: Lookup
    lower: Lookup
    lower_left: Lookup
    shared: np.ndarray


@dataclass(frozen=True)
class Model:
    """Exact `counts` (string, n0, n1) in the shared folder, `n_strings` of them; None without documents of both classes."""

    counts: DataFrame | None
    n_strings: int
    shared: np.ndarray
    curve: np.ndarray

    @cached_property
    def tables(self) -> Tables:
        """The whole model in one process, for looking at a small one. Scoring never asks for it."""
        rows = self.counts.toArrow()
        return tables_of(*[rows[c].to_numpy() for c in ("string", "n0", "n1")], self.shared)

    upper = property(lambda self: self.tables.upper)
    upper_left = property(lambda self: self.tables.upper_left)
    lower = property(lambda self: self.tables.lower)
    lower_left = property(lambda self: self.tables.lower_left)


def strings_of(data: np.ndarray) -> np.ndarray:
    """The UPPER bytes that end at each place from the UPPER-th on, as one number."""
    n = len(data) - UPPER + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(UPPER if n > 0 else 0):
        out = (out << np.uint64(8)) | data[i : i + n]
    return out


def _slots(strings: np.ndarray) -> dict[str, np.ndarray]:
    """The keys of strings in the tables of a model."""
    strings = strings.astype(np.int64)
    lower = strings & ((1 << 8 * LOWER) - 1)
    return {"upper": strings, "upper_left": strings >> 8, "lower": lower, "lower_left": lower >> 8, "shared": strings & 0xFFFF}


@dataclass(frozen=True)
class Buckets:
    """Where strings are scored. All counts behind a string have its three middle bytes in common, which are hashed to `n` buckets.

    Middle bytes that many strings share (`hot`, sorted) have buckets of their own, `parts` of them from `first` on. Each holds all
    their counts, 2 ** 24 at most, and answers a share of the chunks, so that what one task answers does not grow with the corpus.
    """

    n: int
    hot: np.ndarray
    parts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return self.n + np.cumsum(self.parts) - self.parts

    def _places(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Middle bytes, their place among the hot ones, and whether they are there."""
        middle = (strings.astype(np.uint64) >> np.uint64(8)) & np.uint64(0xFFFFFF)
        if not len(self.hot):
            return middle, np.zeros(len(strings), np.int64), np.zeros(len(strings), bool)
        place = np.minimum(np.searchsorted(self.hot, middle.astype(np.int64)), len(self.hot) - 1)
        return middle, place, self.hot[place] == middle.astype(np.int64)

    def asked(self, strings: np.ndarray, chunk: int) -> np.ndarray:
        """The bucket that answers each string of a chunk."""
        middle, place, hot = self._places(strings)
        plain = ((middle * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % self.n
        return np.where(hot, self.first[place] + chunk % self.parts[place], plain) if len(self.hot) else plain

    def holding(self, strings: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of strings, buckets) that hold the counts of strings: one for most, all parts of the hot ones."""
        yield np.arange(len(strings)), self.asked(strings, 0)
        _, place, hot = self._places(strings)
        for part in range(1, int(self.parts.max(initial=0))):
            more = np.flatnonzero(hot & (self.parts[place] > part)) if len(self.hot) else np.zeros(0, np.int64)
            yield more, self.asked(strings[more], part)


def buckets_of(counts: DataFrame, n_strings: int, n: int) -> Buckets:
    """`n` buckets and more for the middle bytes of over half a bucket's strings: at most 2 * n rows come to the driver."""
    middle = F.shiftright("string", 8).bitwiseAND(0xFFFFFF)
    rows = counts.groupBy(middle.alias("m")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") * 2 * n > n_strings).orderBy("m").collect()
    parts = [max(1, -(-r["k"] * n // n_strings)) for r in rows]
    return Buckets(n, np.array([r["m"] for r in rows], np.int64), np.array(parts, np.int64))


def _distinct(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order of appearance, and the place of each number among them."""
    found = pa.array(strings.view(np.int64)).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and a column of sums for each of `values`."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.column_stack([np.bincount(place, v, len(found)) for v in values])


def tables_of(strings: np.ndarray, n0: np.ndarray, n1: np.ndarray, shared: np.ndarray) -> Tables:
    """Tables of distinct strings, which hold all strings of the model with the same middle bytes, or none."""
    kept = lambda n: np.maximum(n - DISCOUNT, 0)
    order = np.argsort(strings)
    strings, n = strings[order].astype(np.int64), np.column_stack([n0, n1])[order]
    at = _slots(strings)
    contexts, sums = _sums(at["upper_left"], *n.T, *kept(n).T)
    endings, seen = _sums(at["lower"], *(n > 0).T)
    short, totals = _sums(endings >> 8, *seen.T, *kept(seen).T)
    return Tables(
        Lookup(strings, kept(n), [0, 0]), Lookup(contexts, _shares(sums[:, :2], sums[:, 2:]), [0, 0, 1, 1]),
        Lookup(endings, kept(seen), [0, 0]), Lookup(short, _shares(totals[:, :2], totals[:, 2:]), [0, 0, 1, 1]), shared,
    )


def training_labels(labels: DataFrame, key: str, label: str, train: Column) -> DataFrame:
    """(`_key`, `_toxic`) of the rows that may teach, one per document."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & train)
    return known.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))


def _key_filter(truth: DataFrame) -> np.ndarray:
    """Bits set at the hashes of the labelled keys, in 2 ** FILTER_BITS: 8 MB for any number of keys."""
    at = F.pmod(F.xxhash64("_key"), F.lit(1 << FILTER_BITS))
    rows = truth.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p")).groupBy("b").agg(
        F.bitmap_construct_agg("p").alias("bits")
    ).toArrow()
    width = 1 << 15
    table = np.zeros((1 << FILTER_BITS) // 8 + 2 * width // 8, np.uint8)
    for b, bits in zip(rows["b"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        table[b * width // 8 : b * width // 8 + len(bits)] |= np.frombuffer(bits, np.uint8)
    return table


def _only_labelled(docs: DataFrame, shared: Broadcast, key: str) -> DataFrame:
    """Drop most rows without a label before any shuffle. The join that follows drops the others."""
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << FILTER_BITS))
    marked = docs.withColumn("_bit", F.bitmap_bucket_number(at) * (1 << 15) + F.bitmap_bit_position(at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array((shared.value[bit // 8] >> (bit % 8).astype(np.uint8)) & 1 == 1))

    return marked.mapInArrow(run, marked.schema).drop("_bit")


def count_strings(docs: DataFrame, text: str, toxic: str) -> DataFrame:
    """(string, n0, n1): how often each string of UPPER bytes occurs in ordinary and in toxic documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], []]
        sizes = [0, 0]
        # With one byte less than a string between texts every string has a byte of one text and none of two.
        gap = b" " * (UPPER - 1)

        def counted(c: int) -> pa.RecordBatch:
            found = pc.value_counts(pa.array(strings_of(np.frombuffer(gap + b"".join(held[c]), np.uint8)).view(np.int64)))
            strings, n = found.field(0), found.field(1).to_numpy()
            held[c], sizes[c] = [], 0
            columns = [n, np.zeros_like(n)] if c == 0 else [np.zeros_like(n), n]
            return pa.RecordBatch.from_arrays([strings, *map(pa.array, columns)], names=["string", "n0", "n1"])

        for batch in batches:
            flags = batch.column(batch.schema.get_field_index(toxic)).to_pylist()
            for body, flag in zip(texts_of(batch, text), flags, strict=True):
                c = int(flag > 0)
                if body:
                    held[c].append(plain(body) + gap)
                    sizes[c] += len(held[c][-1])
                if sizes[c] >= _CHUNK:
                    yield counted(c)
        for c in (0, 1):
            if held[c]:
                yield counted(c)
        give_back()

    part = docs.select(text, toxic).mapInArrow(run, "string long, n0 long, n1 long")
    return part.groupBy("string").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _shares(total: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Per context: one over its count in each class, and the share of it that goes to the lower order."""
    total, known = total.astype(np.float64), known.astype(np.float64)
    over = np.where(total > 0, 1 / np.maximum(total, 1), 0)
    return np.concatenate([over, 1 - known * over], axis=1).astype(np.float32)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge; columns of x are scaled by the caller."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def string_ratios(model: Tables | Model, strings: np.ndarray) -> np.ndarray:
    """log P(last byte | toxic) - log P(last byte | ordinary) after the first bytes of each string."""
    at = _slots(strings)
    left = model.lower_left[at["lower_left"]]
    share = model.lower[at["lower"]] * left[:, :2] + left[:, 2:] * model.shared[at["shared"]][:, None]
    left = model.upper_left[at["upper_left"]]
    share = model.upper[at["upper"]] * left[:, :2] + left[:, 2:] * share
    share = np.log(share)
    return share[:, 1] - share[:, 0]


def byte_ratios(model: Tables | Model, data: np.ndarray) -> np.ndarray:
    """The ratio of each byte from the UPPER-th on."""
    strings, place = _distinct(strings_of(data))
    return string_ratios(model, strings)[place]


def _side_by_side(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of texts, their bytes and lengths: texts in pieces, with neutral bytes between them and before the first."""
    gap, first = max(WINDOWS), 0
    while first < len(texts):
        last, size, parts, lengths = first, 0, [], []
        while last < len(texts) and (last == first or size < _PIECE):
            data = plain(texts[last])
            data = data if data.strip() else b""
            parts += [data, b" " * gap]
            lengths.append(len(data))
            size += len(data) + gap
            last += 1
        yield last - first, np.frombuffer(b" " * (UPPER - 1) + b"".join(parts), np.uint8), np.array(lengths)
        first = last


def ratios(model: Tables | Model, texts: list[bytes], of: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """A row per text: the mean ratio of its bytes, then the largest mean over a window of each width.

    Texts are put side by side with neutral bytes between them, so a window never spans two of them; in a text shorter than
    a window the rest of it counts as neutral. `of` gives the ratios of bytes, if not `model`.
    """
    out = np.zeros((len(texts), 1 + len(WINDOWS)))
    gap = max(WINDOWS)
    first = 0
    for n, flat, lengths in _side_by_side(texts):
        last = first + n
        ratio = (byte_ratios(model, flat) if of is None else of(flat)).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]])
        inside = np.zeros(len(ratio) + 1, np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + lengths, -1)
        outside = np.cumsum(inside[:-1]) == 0
        ratio[outside] = 0
        out[first:last, 0] = np.add.reduceat(ratio, starts) / np.maximum(lengths, 1)
        sums = np.concatenate([[0.0], np.cumsum(ratio), np.zeros(gap)])
        sums[len(ratio) + 1 :] = sums[len(ratio)]
        for i, width in enumerate(WINDOWS):
            windows = (sums[width : width + len(ratio)] - sums[: len(ratio)]) / width
            windows[outside] = -np.inf  # starts behind its text
            out[first:last, 1 + i] = np.where(lengths > 0, np.maximum.reduceat(windows, starts), 0)
        first = last
    return out


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets and the places of their strings."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _dealt(counts: DataFrame, buckets: Buckets) -> DataFrame:
    """(bucket, strings, counts): the model in runs of strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings, n0, n1 = (batch.column(i).to_numpy() for i in range(3))
            rows = [
                (b, strings[places[at]].tobytes(), np.concatenate([n0[places[at]], n1[places[at]]]).tobytes())
                for places, held in buckets.holding(strings) for b, at in _by_bucket(held)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["bucket", "strings", "counts"])

    return counts.select("string", "n0", "n1").mapInArrow(run, "bucket long, strings binary, counts binary")


def _chunk_keys(spark: SparkSession, n: int) -> np.ndarray:
    """One number per hash partition of `n`, so that every chunk has a partition for itself. 8 bytes for CHUNK_BYTES of text."""
    keys, tried = np.full(n, -1), 16 * n + 100
    while (keys < 0).any():
        at = F.pmod(F.hash("id"), F.lit(n))
        rows = spark.range(tried).groupBy(at.alias("at")).agg(F.min("id").alias("key")).toArrow()
        keys[rows["at"].to_numpy()] = rows["key"].to_numpy()
        tried *= 4
    return keys


def _chunked(docs: DataFrame, text: str, keys: np.ndarray) -> DataFrame:
    """(chunk, rows): pieces of rows as compressed Arrow streams, dealt to the chunks in turn.

    Rows are dealt by their place, or copies would share a chunk; chunks become equally large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() * 0x9E3779B1
        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(part)
                rows = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([keys[at % len(keys)]]), rows], names=["chunk", "rows"])
                at += 1
        give_back()

    return docs.mapInArrow(run, "chunk long, rows binary")


def _read(rows: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(rows) as stream:
        yield from stream


def _strings_in(texts: list[bytes]) -> list[np.ndarray]:
    return [_distinct(strings_of(flat))[0] for _, flat, _ in _side_by_side(texts)]


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Distinct numbers in any order."""
    return pc.unique(pa.array(np.concatenate(parts))).to_numpy() if parts else np.zeros(0, np.int64)


class _Gathered:
    """Distinct strings, merged whenever twice as many are held."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.size, self.limit = 0, 1_000_000

    def add(self, parts: list[np.ndarray]) -> None:
        self.parts += parts
        self.size += sum(map(len, parts))
        if self.size > self.limit:
            self.parts = [_merged(self.parts)]
            self.size = len(self.parts[0])
            self.limit = max(2 * self.size, self.limit)

    def strings(self) -> np.ndarray:
        """The distinct strings in order."""
        self.parts = [np.sort(_merged(self.parts))]
        self.size = len(self.parts[0])
        return self.parts[0]


def _asked(chunked: DataFrame, text: str, buckets: Buckets) -> DataFrame:
    """(bucket, chunk, strings): the distinct strings of each chunk, a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Gathered] = {}
        for batch in batches:
            for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in _read(rows.as_buffer()):
                    held.setdefault(chunk, _Gathered()).add(_strings_in(texts_of(part, text)))
        for chunk in list(held):
            strings = held.pop(chunk).strings()
            rows = [(b, chunk, strings[at].tobytes()) for b, at in _by_bucket(buckets.asked(strings, chunk))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["bucket", "chunk", "strings"])
        give_back()

    return chunked.mapInArrow(run, "bucket long, chunk long, strings binary")


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _with_ratios(
    docs: DataFrame, model: Model, text: str, fields: list[tuple[str, T.DataType]], body: Callable[[np.ndarray], list], keep: list[str]
) -> DataFrame:
    """`docs` (its columns `keep`) with columns that `body` makes from the ratios of the texts.

    The chunks are shuffled once: the plan reads that shuffle to ask for the strings and again to score with the answers.
    """
    names = [name for name, _ in fields]
    kept = [c for c in keep if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema, prefers_large_types=False)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    n_chunks = max(-(-size // CHUNK_BYTES), cores)
    n_buckets = max(-(-size // BUCKET_BYTES), -(-model.n_strings // BUCKET_STRINGS), cores)
    buckets = buckets_of(model.counts, model.n_strings, n_buckets)
    keys = _chunk_keys(docs.sparkSession, n_chunks)
    chunked = _chunked(docs.select(*dict.fromkeys([*kept, text])), text, keys).repartition(n_chunks, "chunk")
    shared = model.shared

    def answer(asked: pa.Table, counts: pa.Table) -> pa.Table:
        n = [np.frombuffer(c, np.int64).reshape(2, -1) for c in counts["counts"].to_pylist()]
        tables = tables_of(_numbers(counts["strings"], np.int64), *np.concatenate([np.zeros((2, 0), np.int64), *n], axis=1), shared)
        told = [string_ratios(tables, np.frombuffer(s.as_buffer(), np.int64)).astype(np.float32).tobytes() for s in asked["strings"]]
        give_back()
        return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "ratios": pa.array(told, pa.binary())})

    def scored(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        gathered = _Gathered()
        for rows in chunk["rows"]:
            for part in _read(rows.as_buffer()):
                gathered.add(_strings_in(texts_of(part, text)))
        strings = gathered.strings()
        told = np.zeros(len(strings), np.float32)
        by_bucket = dict(zip(answers["bucket"].to_pylist(), answers["ratios"].to_pylist(), strict=True))
        # The chunk is the same in all rows of its group.
        for b, at in _by_bucket(buckets.asked(strings, chunk["chunk"][0].as_py())):
            told[at] = np.frombuffer(by_bucket[b], np.float32)  # fails if they are not as many as were asked for

        def of(flat: np.ndarray) -> np.ndarray:
            wanted, place = _distinct(strings_of(flat))
            return told[np.searchsorted(strings, wanted)][place]

        made = []
        for rows in chunk["rows"]:
            for part in _read(rows.as_buffer()):
                new = body(ratios(None, texts_of(part, text), of))
                columns = [*[part.column(part.schema.get_field_index(c)) for c in kept], *map(pa.array, new)]
                made.append(pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow))
        del strings, told, by_bucket
        give_back()
        return pa.Table.from_batches(made, arrow)

    asked = _asked(chunked, text, buckets).groupBy("bucket")
    answers = asked.cogroup(_dealt(model.counts, buckets).groupBy("bucket")).applyInArrow(answer, "chunk long, bucket long, ratios binary")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
    train: Column | None = None, curve_rows: int = CURVE_ROWS,
) -> Model:
    """Count both classes and fit the curve. `train` tells which label rows may teach (all, if None).

    `curve_rows` bounds the labelled documents that fit the curve; the counts cover these, once it is fitted, and all others.
    """
    truth = materialize(training_labels(labels, key, label, F.lit(True) if train is None else train), "truth")
    in_slice = F.pmod(F.xxhash64(F.col("_key"), F.lit("curve")), F.lit(SLICES)) == 0
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.col("_key").isNotNull())
    labelled = docs.sparkSession.sparkContext.broadcast(_key_filter(truth))
    picked = truth.filter(in_slice).orderBy(F.xxhash64(F.col("_key"), F.lit("order")), "_key").limit(curve_rows)
    few = materialize(picked, "curve")  # at most curve_rows rows
    held = materialize(_only_labelled(rows, labelled, "_key").join(F.broadcast(few), "_key"), "curve_rows")
    counted = _only_labelled(rows, labelled, "_key").join(truth.join(F.broadcast(few.select("_key")), "_key", "left_anti"), "_key")
    counts = materialize(count_strings(counted, "_text", "_toxic"), "strings")
    more = count_strings(held, "_text", "_toxic")
    both = counts.unionByName(more).groupBy("string").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    both = materialize(both, "all_strings")
    labelled.destroy()
    full, bare = _uncurved(both), _uncurved(counts)
    if full.counts is None:
        return full
    x, y = (np.zeros((0, 0)), np.zeros(0, bool)) if bare.counts is None else _curve_rows(held, bare)
    if y.any() and not y.all():
        scale = np.maximum(x.std(axis=0), 1e-6)
        beta = _logistic(x / scale, y.astype(float))
        curve = np.concatenate([beta[:1], beta[1:] / scale])
    else:  # too few labelled documents for a curve: toxic once the likeliest window is
        curve = np.concatenate([[-2.0], np.zeros(len(WINDOWS)), [2.0]])
    return replace(full, curve=curve)


def _uncurved(counts: DataFrame) -> Model:
    n_strings, *n = counts.agg(F.count(F.lit(1)), F.sum("n0"), F.sum("n1")).first()
    return Model(counts, n_strings, _shared(counts), np.zeros(0)) if all(n) else Model(None, 0, np.zeros(0), np.zeros(0))


def _shared(counts: DataFrame) -> np.ndarray:
    """The share of each last byte after the one before it, by how many strings of either class end so: 2 ** 16 numbers."""
    kinds = F.sum((F.col("n0") > 0).cast("int") + (F.col("n1") > 0).cast("int"))
    rows = counts.groupBy(F.col("string").bitwiseAND(0xFFFF).alias("at")).agg(kinds.alias("n")).toArrow()
    n = np.full(1 << 16, 0.1)
    n[rows["at"].to_numpy()] += rows["n"].to_numpy()
    n = n.reshape(256, 256)
    return (n / n.sum(axis=1, keepdims=True)).ravel().astype(np.float32)


def _curve_rows(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    names = [f"r{i}" for i in range(1 + len(WINDOWS))]
    made = _with_ratios(rows, model, "_text", [(n, T.DoubleType()) for n in names], lambda x: list(x.T), ["_key", "_toxic"])
    shown = made.dropDuplicates(["_key"]).orderBy("_key").toArrow()  # a row per key picked
    return np.column_stack([shown[n].to_numpy() for n in names]), shown["_toxic"].to_numpy() > 0


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Add `score` (0 to 1, higher: likelier toxic) and `predicted` (1 from `threshold` on)."""
    wanted = docs.columns if keep is None else keep
    if model.counts is None:
        return docs.select(*[c for c in wanted if c not in ("score", "predicted")], F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    curve = model.curve

    def body(x: np.ndarray) -> list:
        values = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -40, 40)))
        return [values, (values >= threshold).astype(np.int32)]

    return _with_ratios(docs, model, text, [("score", T.DoubleType()), ("predicted", T.IntegerType())], body, wanted)
