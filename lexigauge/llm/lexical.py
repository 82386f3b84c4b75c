"""Ranked lexical search: the best documents of every item by integer term scores, accumulator-limited, a term at a time.

Documents are scanned once for the terms that items ask for; what is found (a document's length, its asked terms and their
counts) is written as a narrow table, from which the corpus-wide numbers come. Each task then takes its share of that table in
segments, turns a segment into postings and works off every item's terms, rarest first. Each posting adds to its document's
accumulator. As soon as all terms left together cannot lift a new document to the k-th best score (of this segment so far, or of
the task's earlier segments), no accumulator is created any more: the terms left only update the documents that can still get
there, and do so exactly. A task hands on k rows an item, whatever the number of its documents; these are merged in two steps.

Items are dealt into blocks of about BLOCK_TERMS distinct (item, term) pairs, so that what is broadcast stays bounded however
many items there are; each block is one scan. An item's own terms are never split.

Defined cases: null and empty texts, and texts without a term, are documents of no term: they count nowhere and are never found;
items without a term, or without a document of positive score, return no row; rows of one item key are one item with the terms of
all of them (a null key is a key); every row of documents is a document of its own, so repeated rows are all ranked, in any order
among themselves; null document keys come after all others; empty tables give an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import PIECE_BYTES, plain, text_pieces, texts_of
from lexigauge.sources.scratch import materialize

#: (item, term) pairs that are searched in one scan, about; postings that a task holds at once, or one document's.
BLOCK_TERMS, SEGMENT_POSTINGS = 500_000, 2_000_000
#: Parts that the rows of an item are merged in before they meet.
MERGE_PARTS = 64


@dataclass(frozen=True)
class Query:
    """The items of a block: their keys and, item by item, their term numbers, rarest first, with a weight per term."""

    keys: pa.Array
    terms: list[np.ndarray]
    weights: np.ndarray


def _item_terms(items: DataFrame, text: str, key: str) -> DataFrame:
    """(item, term): the distinct terms of every item."""
    schema = T.StructType([T.StructField("item", items.schema[key].dataType), T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [list(set(plain(t).split())) for t in texts_of(batch, text)]
            item = batch.column(batch.schema.get_field_index(key)).take(pa.array(np.repeat(np.arange(len(terms)), list(map(len, terms)))))
            yield pa.RecordBatch.from_arrays([item, pa.array([t for row in terms for t in row], pa.binary())], names=["item", "term"])

    return items.select(*dict.fromkeys([key, text])).mapInArrow(run, schema).distinct()


def _found(docs: DataFrame, text: str, key: str, numbers: Broadcast) -> DataFrame:
    """(doc, n, terms, counts): the number of terms of every document, and its asked terms."""
    schema = T.StructType([
        T.StructField("doc", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                lengths, codes = [], []
                for i, body in enumerate(texts_of(part, text)):
                    words = plain(body).split()
                    at = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                    codes.append(at[at >= 0] + (i << 32))
                    lengths.append(len(words))
                held, counts = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64),) * 2
                ends = pa.array(np.searchsorted(held, np.arange(len(lengths) + 1) << 32).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (held & 0xFFFFFFFF, counts)]
                columns = [part.column(part.schema.get_field_index(key)), pa.array(lengths, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """Postings of some documents: per term the documents in order, and what an occurrence is worth there without its weight."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, n_docs: int, n_terms: int, n_asked: int) -> None:
        self.keys = batch["doc"].combine_chunks() if isinstance(batch, pa.Table) else batch["doc"]
        lists = [pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in (batch["terms"], batch["counts"])]
        terms, counts = (pc.list_flatten(c).to_numpy().astype(np.int64) for c in lists)
        self.size = len(self.keys)
        doc = np.repeat(np.arange(self.size), pc.list_value_length(lists[0]).to_numpy().astype(np.int64))
        # Python's integers: 90 * n * N may leave 64 bits before the division on a very large corpus.
        m = np.array([10 + 90 * n * n_docs // n_terms for n in batch["n"].to_pylist()], np.int64)
        order = np.argsort(terms, kind="stable")
        self.docs = doc[order]
        self.worth = (1_000_000_000 * counts // (1000 * counts + 8 * m[doc]))[order]
        self.ends = np.searchsorted(terms[order], np.arange(n_asked + 1))
        self.most = np.zeros(n_asked, np.int64)
        held = np.flatnonzero(np.diff(self.ends))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.worth, self.ends[held])
        self.place = np.empty(self.size, np.int64)  # of each document in the order of keys, nulls last
        self.place[pc.sort_indices(self.keys, null_placement="at_end").to_numpy()] = np.arange(self.size)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The documents of the k best scores, these scores, and how many accumulators there were.

        Documents below `floor` may be missing. `terms`: rarest first.
        """
        terms = terms[self.most[terms] * weights[terms] > 0]
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        bounds = self.most[terms] * weights[terms]
        left = np.cumsum(bounds[::-1])[::-1]  # what the terms from this one on can add at most
        total = np.zeros(self.size, np.int64)
        kth, reach = 0, 0  # the k-th partial score when last seen, and what it can have become
        alive = None
        for at, term in enumerate(terms):
            span = slice(self.ends[term], self.ends[term + 1])
            docs, added = self.docs[span], self.worth[span] * weights[term]
            if alive is None and left[at] < max(reach, floor):
                kth = reach = self._kth(total, k)
                if left[at] < max(kth, floor):
                    alive = (total > 0) & (total + left[at] >= max(kth, floor))
            if alive is None:
                total[docs] += added
                reach += bounds[at]
            else:
                held = alive[docs]
                total[docs[held]] += added[held]
        n = int(np.count_nonzero(total))
        if alive is not None:
            total[~alive] = 0
        found = np.flatnonzero(total >= max(self._kth(total, k), floor, 1))
        found = found[np.lexsort((self.place[found], -total[found]))][:k]
        return found, total[found], n

    def _kth(self, total: np.ndarray, k: int) -> int:
        return int(np.partition(total, len(total) - k)[len(total) - k]) if len(total) >= k else 0


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows up to SEGMENT_POSTINGS postings and as many documents, or one document."""
    held, size = [], 0
    for batch in batches:
        lengths = np.cumsum(pc.list_value_length(batch["terms"]).to_numpy().astype(np.int64) + 1)
        first = 0
        while first < batch.num_rows:
            before = lengths[first - 1] if first else 0
            stop = max(int(np.searchsorted(lengths, before + SEGMENT_POSTINGS - size, side="right")), first if held else first + 1)
            if stop > first:
                held.append(batch.slice(first, stop - first))
                size += int(lengths[stop - 1] - before)
            if stop < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            first = stop
    if held:
        yield pa.Table.from_batches(held)


def _best(found: DataFrame, query: Broadcast, k: int, n_docs: int, n_terms: int, schema: T.StructType) -> DataFrame:
    """(item, doc, score, part): each task's k best documents of every item."""
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Query = query.value
        best: list[list[tuple]] = [[] for _ in asked.terms]  # (-score, key is null, key)
        for table in _segments(batches):
            segment = Segment(table, n_docs, n_terms, len(asked.weights))
            for i, terms in enumerate(asked.terms):
                floor = -best[i][-1][0] if len(best[i]) >= k else 0
                docs, scores, _ = segment.search(terms, asked.weights, k, floor)
                if len(docs):
                    keys = segment.keys.take(pa.array(docs)).to_pylist()
                    rows = [(-s, key is None, key) for s, key in zip(scores.tolist(), keys, strict=True)]
                    # A null is never compared: False < True decides before it, and of two null keys the first is as good.
                    best[i] = sorted(best[i] + rows, key=lambda r: r[:2] if r[1] else r)[:k]
        part = TaskContext.get().partitionId() % MERGE_PARTS
        rows = [(i, key, -score) for i, kept in enumerate(best) for score, _, key in kept]
        if rows:
            item, doc, score = zip(*rows, strict=True)
            columns = [asked.keys.take(pa.array(item)), pa.array(doc, arrow.field(1).type), pa.array(score), pa.array([part] * len(rows))]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)

    return found.select("doc", "n", "terms", "counts").mapInArrow(run, schema)


def _query(pairs: pa.Table, numbers: dict[bytes, int], df: np.ndarray, n_docs: int) -> Query:
    """`pairs`: (item, term) of a block."""
    weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
    keys = pairs["item"].combine_chunks()
    code = keys.dictionary_encode(null_encoding="encode")
    term = np.array([numbers[t] for t in pairs["term"].to_pylist()], np.int64)
    order = np.lexsort((term, -weights[term], code.indices.to_numpy()))
    ends = np.searchsorted(code.indices.to_numpy()[order], np.arange(1, len(code.dictionary)))
    return Query(code.dictionary, np.split(term[order], ends), weights)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_key, rank, key, score): the k best documents of every item with a score above 0, equal scores by ascending key.

    Where both tables call their key alike, the item's is returned as `item_<key>`.
    """
    if k < 1 or block_terms < 1:
        raise ValueError("k and block_terms are 1 at least")
    spark = docs.sparkSession
    item_type, doc_type = items.schema[item_key].dataType, docs.schema[key].dataType
    rows_type = T.StructType([
        T.StructField("item", item_type), T.StructField("doc", doc_type), T.StructField("score", T.LongType()), T.StructField("part", T.LongType()),
    ])
    asked = materialize(_item_terms(items, item_text, item_key), "item_terms")
    n_blocks = -(-asked.count() // block_terms)
    results = [spark.createDataFrame([], rows_type)]
    for block in range(n_blocks):
        pairs = asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).toArrow()  # about block_terms rows
        numbers = {t: i for i, t in enumerate(sorted(set(pairs["term"].to_pylist())))}
        shared = spark.sparkContext.broadcast(numbers)
        found = materialize(_found(docs, text, key, shared), "found")
        shared.destroy()
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not numbers or not n_docs:
            continue
        df = np.zeros(len(numbers), np.int64)
        held = found.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row per asked term
        df[held["t"].to_numpy()] = held["count"].to_numpy()
        query = spark.sparkContext.broadcast(_query(pairs, numbers, df, n_docs))
        results.append(_best(found, query, k, n_docs, n_terms, rows_type))
    every = results[0] if len(results) == 1 else results[1]
    for more in results[2:]:
        every = every.unionByName(more)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    first = every.withColumn("_r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("_r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_key if item_key != key else f"item_{key}"), "rank", F.col("doc").alias(key), "score")
