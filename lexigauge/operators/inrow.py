"""Features looked up inside a document's row: no row per term, no shuffle.

The weight table of some models (see operators.weights) is collected once, sent to every task, and a batch of documents is looked up
in it at once: all terms of the batch in one hash lookup over the distinct terms of the models, the rest by array arithmetic. What
comes back is one row per document and model, or one per known term where that is the result.

The table must fit a broadcast, which is measured: `lookup_of` counts as it collects and gives None beyond BROADCAST_ROWS rows. The
operators then join rows of terms instead.
"""

import ctypes
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge import config
from lexigauge.config import SIGNALS

INTERCEPT = "[intercept]"
#: Entries of documents that a task looks up at once.
AT_ONCE = 200_000
ENTRIES = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("value", T.DoubleType())]))
#: A sparse vector as MLlib stores it in Parquet.
VECTOR = T.StructType([
    T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
    T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType())),
])


def signal_key(name: str) -> str:
    return f"[{name}]"


@dataclass(frozen=True)
class Lookup:
    """The weights of some models as arrays: a row per model, a column per distinct term (and one more for unknown ones)."""

    models: list[int]
    terms: pa.Array
    rank: np.ndarray  # of each term, then of each signal, in the order of the strings
    known: np.ndarray
    slot: np.ndarray
    idf: np.ndarray
    coef: np.ndarray
    mean: np.ndarray  # of the signals, as the two below
    std: np.ndarray
    signal_coef: np.ndarray
    intercept: np.ndarray

    @property
    def names(self) -> pa.Array:
        return pa.concat_arrays([self.terms, pa.array([signal_key(s) for s in SIGNALS], pa.string())])


def lookup_of(weights: DataFrame, most: int | None = None) -> Lookup | None:
    """A weight table as arrays, or None if it has more rows than a broadcast should have."""
    most = config.BROADCAST_ROWS if most is None else most
    wanted = ("model", "key", "slot", "is_term", "idf", "mean", "std", "coef")
    there = [F.col(c) if c in weights.columns else F.lit(None).cast("double").alias(c) for c in wanted]
    table = weights.select(*there).limit(most + 1).toArrow()
    if table.num_rows > most:
        return None
    number = lambda c: table[c].cast(pa.float64()).fill_null(0).to_numpy()
    models = sorted(set(table["model"].to_pylist()))
    row = np.searchsorted(models, table["model"].to_numpy()) if models else np.zeros(0, np.int64)
    is_term = table["is_term"].to_numpy(zero_copy_only=False).astype(bool)
    keys = table["key"].combine_chunks()
    terms = pc.unique(keys.filter(pa.array(is_term))).cast(pa.string())
    at = pc.index_in(keys, value_set=pa.concat_arrays([terms, pa.array([signal_key(s) for s in SIGNALS], pa.string())])).fill_null(-1).to_numpy()
    rank = np.empty(len(terms) + len(SIGNALS), np.int64)
    rank[pc.sort_indices(pa.concat_arrays([terms, pa.array([signal_key(s) for s in SIGNALS], pa.string())])).to_numpy()] = np.arange(len(rank))

    def grid(values: np.ndarray, rows: np.ndarray, width: int, first: int, default: float, kind: type) -> np.ndarray:
        out = np.full((len(models), width), default, kind)
        out[row[rows], at[rows] - first] = values[rows]
        return out

    signals = ~is_term & (at >= 0)
    constant = ~is_term & (at < 0)
    intercept = np.zeros(len(models))
    intercept[row[constant]] = number("coef")[constant]
    n, every = len(terms), np.ones(table.num_rows, bool)
    return Lookup(
        models, terms, rank, grid(every, is_term, n + 1, 0, False, bool), grid(number("slot"), is_term, n + 1, 0, 0, np.int64),
        grid(number("idf"), is_term, n + 1, 0, 0.0, np.float64), grid(number("coef"), is_term, n + 1, 0, 0.0, np.float64),
        grid(number("mean"), signals, len(SIGNALS), n, 0.0, np.float64), grid(number("std"), signals, len(SIGNALS), n, 1.0, np.float64),
        grid(number("coef"), signals, len(SIGNALS), n, 0.0, np.float64), intercept,
    )


@dataclass(frozen=True)
class Found:
    """What some documents have of one model: per known term its document, place and weight; per document norm and signals."""

    lookup: Lookup
    model: int  # its row in the lookup
    size: int
    doc: np.ndarray
    place: np.ndarray
    weight: np.ndarray  # before the norm
    norm: np.ndarray  # 1 for a document without known terms
    signals: np.ndarray  # standardised

    @property
    def known_terms(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.size)

    def lists(self, doc: np.ndarray) -> pa.Array:
        """Offsets of one list per document for entries in the order of their documents."""
        return pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=self.size))]).astype(np.int32))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with AT_ONCE entries of `counted`, or one row: the arrays made of them stay small, however large a batch is."""
    for batch in batches:
        ends, done = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("counted")), 0).to_numpy()), 0
        while done < batch.num_rows:
            stop = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + AT_ONCE, side="right")), done + 1)
            yield batch.slice(done, stop - done)
            done = stop
    # Workers outlive their stage, and the next one needs the memory.
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Document, term and count of every entry of `counted`."""
    lists = batch.column("counted")
    flat = pc.list_flatten(lists)
    return pc.list_parent_indices(lists).to_numpy().astype(np.int64), flat.field("term"), flat.field("cnt").to_numpy()


def _found(lookup: Lookup, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Found]]:
    """For every model the places of its documents in the batch and what they have of it."""
    doc, terms, counts = _entries(batch)
    place = pc.index_in(terms, value_set=lookup.terms).fill_null(-1).to_numpy().astype(np.int64)
    here = place >= 0
    doc, place, weight = doc[here], place[here], 1 + np.log(counts[here])
    signals = np.column_stack([batch.column(s).to_numpy(zero_copy_only=False).astype(np.float64) for s in SIGNALS])
    if "models" in batch.schema.names:
        lists = batch.column("models")
        member, wanted = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy()
    for m, model in enumerate(lookup.models):
        docs = member[wanted == model].astype(np.int64) if "models" in batch.schema.names else np.arange(batch.num_rows)
        if not len(docs):
            continue
        at = np.full(batch.num_rows, -1)
        at[docs] = np.arange(len(docs))
        mine = lookup.known[m, place] & (at[doc] >= 0)
        own, places = at[doc[mine]], place[mine]
        value = weight[mine] * lookup.idf[m, places]
        norm = np.sqrt(np.bincount(own, value * value, len(docs)))
        yield docs, Found(lookup, m, len(docs), own, places, value, np.where(norm > 0, norm, 1.0), (signals[docs] - lookup.mean[m]) / lookup.std[m])


def per_model(
    docs: DataFrame, lookup: Lookup, keys: Sequence[str], fields: Sequence[tuple[str, T.DataType]], body: Callable[[Found], list[pa.Array | np.ndarray]]
) -> DataFrame:
    """(model, keys..., fields...): one row per document and model, in the scan's own tasks.

    `docs` needs `counted` and the signals; an array column `models` says which models a document belongs to (without one, to all).
    """
    shared = docs.sparkSession.sparkContext.broadcast(lookup)
    chosen = ["models"] if "models" in docs.columns else []
    narrow = docs.select(*dict.fromkeys([*keys, "counted", *SIGNALS, *chosen]))
    schema = T.StructType([T.StructField("model", T.IntegerType()), *[docs.schema[k] for k in keys], *[T.StructField(n, t) for n, t in fields]])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lookup = shared.value
        for batch in _pieces(batches):
            for at, found in _found(table, batch):
                rows = pa.array(at)
                made = [pa.array(np.full(len(at), table.models[found.model])), *[batch.column(k).take(rows) for k in keys], *map(_arrow, body(found))]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(made, arrow, strict=True)], schema=arrow)

    return narrow.mapInArrow(run, schema)


def _arrow(values: pa.Array | np.ndarray) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def scores(docs: DataFrame, lookup: Lookup, keys: Sequence[str]) -> DataFrame:
    """(model, keys..., known_terms, z)."""

    def body(found: Found) -> list:
        m, table = found.model, found.lookup
        terms = np.bincount(found.doc, found.weight * table.coef[m, found.place], found.size) / found.norm
        return [found.known_terms, terms + found.signals @ table.signal_coef[m] + table.intercept[m]]

    return per_model(docs, lookup, keys, [("known_terms", T.LongType()), ("z", T.DoubleType())], body)


def contributions(docs: DataFrame, lookup: Lookup, keys: Sequence[str]) -> DataFrame:
    """(model, keys..., known_terms, z, contributions): terms and signals by falling size, ties by name."""

    def body(found: Found) -> list:
        m, table = found.model, found.lookup
        n_terms = len(table.terms)
        doc = np.concatenate([found.doc, np.repeat(np.arange(found.size), len(SIGNALS))])
        place = np.concatenate([found.place, np.tile(np.arange(n_terms, n_terms + len(SIGNALS)), found.size)])
        value = np.concatenate([found.weight / found.norm[found.doc] * table.coef[m, found.place], (found.signals * table.signal_coef[m]).ravel()])
        order = np.lexsort((table.rank[place], -np.abs(value), doc))
        named = pa.StructArray.from_arrays([table.names.take(pa.array(place[order])), pa.array(value[order])], names=["term", "value"])
        z = np.bincount(doc, value, found.size) + table.intercept[m]
        return [found.known_terms, z, pa.ListArray.from_arrays(found.lists(doc), named)]

    return per_model(docs, lookup, keys, [("known_terms", T.LongType()), ("z", T.DoubleType()), ("contributions", ENTRIES)], body)


def vectors(docs: DataFrame, lookup: Lookup, keys: Sequence[str], size: int) -> DataFrame:
    """(model, keys..., features): normalised terms and standardised signals as a stored sparse vector, see VECTOR."""

    def body(found: Found) -> list:
        m, table = found.model, found.lookup
        doc = np.concatenate([np.repeat(np.arange(found.size), len(SIGNALS)), found.doc])
        slot = np.concatenate([np.tile(np.arange(len(SIGNALS)), found.size), table.slot[m, found.place]])
        value = np.concatenate([found.signals.ravel(), found.weight / found.norm[found.doc]])
        order = np.lexsort((slot, doc))
        offsets = found.lists(doc)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (slot.astype(np.int32), value)]
        kind = [pa.array(np.zeros(found.size, np.int8)), pa.array(np.full(found.size, size, np.int32))]
        return [pa.StructArray.from_arrays([*kind, *lists], names=VECTOR.names)]

    return per_model(docs, lookup, keys, [("features", VECTOR)], body)


def slopes(docs: DataFrame, lookup: Lookup, label: str) -> DataFrame:
    """(model, key, slope, n, loss): per batch of documents and key what the labels are above the scores, times the feature.

    Summed by model and key, `slope` is the negative slope of the log loss; `n` and `loss` come with the intercept's key. A batch
    gives one row per feature that occurs in it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lookup)
    chosen = ["models"] if "models" in docs.columns else []
    schema = T.StructType([
        T.StructField("model", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("slope", T.DoubleType()),
        T.StructField("n", T.LongType()), T.StructField("loss", T.DoubleType()),
    ])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lookup = shared.value
        names = pa.concat_arrays([table.names, pa.array([INTERCEPT])])
        for batch in _pieces(batches):
            labels = batch.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
            for at, found in _found(table, batch):
                m, y = found.model, labels[at]
                x = found.weight / found.norm[found.doc]
                z = np.bincount(found.doc, x * table.coef[m, found.place], found.size) + found.signals @ table.signal_coef[m] + table.intercept[m]
                above = y - 1 / (1 + np.exp(-z))
                loss = np.sum(np.logaddexp(0, z) - y * z)
                terms = np.bincount(found.place, x * above[found.doc], len(table.terms))
                slope = np.concatenate([terms, found.signals.T @ above, [above.sum()]])
                keep = np.append(np.flatnonzero(slope[:-1]), len(slope) - 1)
                last = np.arange(len(keep)) == len(keep) - 1
                made = [
                    pa.array(np.full(len(keep), table.models[m])), names.take(pa.array(keep)), pa.array(slope[keep]),
                    pa.array(np.where(last, found.size, 0)), pa.array(np.where(last, loss, 0.0)),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)

    return docs.select(*dict.fromkeys([label, "counted", *SIGNALS, *chosen])).mapInArrow(run, schema)


def term_weights(docs: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame | None:
    """(key, term, weight) with the weights of a document L2-normalised; `vocabulary` (term, idf). None if that is too large."""
    lookup = lookup_of(vocabulary.select(F.lit(0).alias("model"), F.col("term").alias("key"), F.lit(0).alias("slot"), F.lit(True).alias("is_term"), "idf"))
    if lookup is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(lookup)
    schema = T.StructType([docs.schema[key], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lookup = shared.value
        for batch in _pieces(batches):
            doc, terms, counts = _entries(batch)
            place = pc.index_in(terms, value_set=table.terms).fill_null(-1).to_numpy().astype(np.int64)
            here = place >= 0
            doc, place = doc[here], place[here]
            value = (1 + np.log(counts[here])) * table.idf.ravel()[place] if len(place) else np.zeros(0)
            norm = np.sqrt(np.bincount(doc, value * value, batch.num_rows))
            made = [batch.column(key).take(pa.array(doc)), table.terms.take(pa.array(place)), pa.array(value / norm[doc])]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(made, arrow, strict=True)], schema=arrow)

    return docs.select(*dict.fromkeys([key, "counted"])).mapInArrow(run, schema)


