"""Nearest neighbours by largest inner product, by a block matrix join.

Vectors are packed into blocks by a hash of their id, queries likewise. Every vector is also kept as int8 with a scale. A tile, a block of
queries against a block of vectors, is a product of two int8 matrices; the norms of what quantisation lost bound the error of
each entry. A pair stays if its largest possible score reaches the k-th largest score that is certain so far. The pairs that
stay are recomputed in double precision and pushed on a heap per query; a task keeps the heaps of the query blocks it meets.
The heaps of the tasks are merged at the end. So the result is exact.

Query blocks are sent once to every group of vector blocks, not once to every block; vectors are moved once.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id take no part; a
vector meets those of its own length only; every row counts, also of an id that several rows share: each of its vectors is a query,
and a candidate for all rows but itself (equal rows are candidates for each other, and one query); equal scores go to the smaller
id; components may be as large or small as doubles are, pairs whose product is not a number take no part; a query with no candidate
has no rows; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexigauge.sources.scratch import materialize

#: Rows of a block of queries and of vectors, and groups of vector blocks per core; each group gets a copy of the queries.
QUERY_ROWS, VECTOR_ROWS, GROUPS_PER_CORE = 512, 2048, 2
#: Pairs that are recomputed at once.
_PAIRS = 200_000
_BLOCK = "dim int, block long, ids binary, copies binary, vectors binary, codes binary, scales binary, norms binary, lost binary"


def usable(vector: str) -> Column:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the coded vector and norm of what the code loses, per row."""
    scale = np.abs(x).max(axis=1) / 127  # 0 for the smallest numbers there are: then the code is 0 and loses the whole vector
    codes = np.clip(np.rint(x / np.where(scale > 0, scale, np.inf)[:, None]), -127, 127).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, _norm(coded), _norm(x - coded)


def _norm(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, without squares that overflow or vanish."""
    largest = np.abs(x).max(axis=1)
    return largest * np.linalg.norm(x / np.where(largest > 0, largest, 1)[:, None], axis=1)


def blocks(vectors: DataFrame, key: str, vector: str, rows: int, copies: int = 1) -> DataFrame:
    """A row per block of at most about `rows` vectors of one length; of equal rows at most `copies`, numbered from 0."""
    one = vectors.filter(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    counted = one.groupBy("id", "v").agg(F.least(F.count(F.lit(1)), F.lit(copies)).alias("_n"))
    numbered = counted.select("id", "v", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("copy"))
    one = materialize(numbered, "vectors")
    sizes = {r["dim"]: max(1, -(-r["count"] // rows)) for r in one.groupBy("dim").count().collect()}  # a row per vector length
    if not sizes:
        return vectors.sparkSession.createDataFrame([], _BLOCK)
    count = F.lit(1)
    for dim, n in sizes.items():
        count = F.when(F.col("dim") == dim, F.lit(n)).otherwise(count)
    placed = one.withColumn("block", F.pmod(F.xxhash64("id", "v", "copy"), count).cast("long"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["v"].to_list()).astype(np.float64)
        codes, *rest = quantise(x)
        return pd.DataFrame([[
            int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0]), *[pdf[c].to_numpy(np.int64).tobytes() for c in ("id", "copy")], x.tobytes(), codes.tobytes(),
            *[r.tobytes() for r in rest],
        ]], columns=[c.split()[0] for c in _BLOCK.split(", ")])

    return placed.groupBy("dim", "block").applyInPandas(pack, _BLOCK)


class Block:
    """A packed block, read from a row's binary columns."""

    def __init__(self, dim: int, row: dict, prefix: str) -> None:
        get = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.ids, self.copies = get("ids", np.int64), get("copies", np.int64)
        self.scales, self.norms, self.lost = get("scales", float), get("norms", float), get("lost", float)
        self.vectors, self.codes = get("vectors", float).reshape(-1, dim), get("codes", np.int8).reshape(-1, dim)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component to the last."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def tile(q: Block, v: Block, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query row, vector row, score) of the pairs that may be among a query's k best, at scores of `floor` or more."""
    kind = np.float32 if q.codes.shape[1] <= 1024 else np.float64  # sums of such products are exact integers
    with np.errstate(over="ignore", invalid="ignore"):
        near = (q.codes.astype(kind) @ v.codes.astype(kind).T).astype(np.float64) * q.scales[:, None] * v.scales
        # |x.y - coded| <= |x - coded x||y| + |coded x||y - coded y|, with |y| <= |coded y| + what y lost
        error = q.lost[:, None] * (v.norms + v.lost) + q.norms[:, None] * v.lost
        error += 1e-12 * (q.norms + q.lost)[:, None] * (v.norms + v.lost) + 8 * q.codes.shape[1] * np.finfo(float).tiny
        least, most = near - error, near + error
    same_id = np.argwhere(q.ids[:, None] == v.ids)
    own = np.array([(i, j) for i, j in same_id.tolist() if v.copies[j] == 0 and np.array_equal(q.vectors[i], v.vectors[j])], int).reshape(-1, 2)
    # Beyond the range of doubles a bound is no number, or no bound: nothing is sure then, and the pair is recomputed.
    least[~np.isfinite(near) | np.isnan(least)] = -np.inf
    least[own[:, 0], own[:, 1]] = -np.inf
    if near.shape[1] > k:
        sure = np.partition(least, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        floor = np.maximum(floor, sure)
    kept = ~(most < floor[:, None]) | ~np.isfinite(near)
    kept[own[:, 0], own[:, 1]] = False
    at = np.argwhere(kept)
    for first in range(0, len(at), _PAIRS):
        i, j = at[first : first + _PAIRS].T
        with np.errstate(over="ignore", invalid="ignore"):
            scores = inner(q.vectors[i], v.vectors[j])
        number = ~np.isnan(scores)
        yield i[number], j[number], scores[number]


def push(heaps: list[list], i: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Keep the k best of each query: larger score first, then smaller id."""
    for row, vec, score in zip(i.tolist(), ids.tolist(), scores.tolist(), strict=True):
        heap = heaps[row]
        if len(heap) < k:
            heapq.heappush(heap, (score, -vec))
        elif (score, -vec) > heap[0]:
            heapq.heapreplace(heap, (score, -vec))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows of `vectors` other than its own."""
    groups = GROUPS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism
    # More than k + 1 equal rows change nothing: one is left out for an equal query, and k fill its ranks.
    v = materialize(blocks(vectors, key, vector, VECTOR_ROWS, k + 1), "vector_blocks").withColumn("part", F.col("block") % groups)
    q = materialize(blocks(queries, key, vector, QUERY_ROWS), "query_blocks")
    parts = v.groupBy("dim").agg(F.max("part").alias("_last"))
    sent = q.join(parts, "dim").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "_last"))).drop("_last")
    fields = [c.split()[0] for c in _BLOCK.split(", ")][1:]
    sent = sent.select("dim", "part", *[F.col(c).alias(f"q_{c}") for c in fields])
    # Both sides are partitioned by the group; a row of the join is a tile, and a few tiles make a batch.
    pairs = v.select("dim", "part", *[F.col(c).alias(f"v_{c}") for c in fields]).join(sent.hint("merge"), ["dim", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, list[list]]] = {}

        def result(name: tuple[int, int], ids: np.ndarray, heaps: list[list]) -> pa.RecordBatch:
            sizes = [len(h) for h in heaps]
            flat = [pair for h in heaps for pair in h]
            place = np.repeat(np.arange(len(ids)), sizes)
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.array(np.full(len(flat), x)) for x in name], pa.array(place), pa.array(np.repeat(ids, sizes)),
                    pa.array([-n for _, n in flat], pa.int64()), pa.array([s for s, _ in flat], pa.float64()),
                ],
                names=["dim", "block", "place", "query_id", "vec_id", "score"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
                a, b = Block(one["dim"], one, "q_"), Block(one["dim"], one, "v_")
                name = (one["dim"], one["q_block"])
                if name not in held:
                    if len(held) >= 64:  # heaps of other query blocks go on as they are
                        oldest = next(iter(held))
                        yield result(oldest, *held.pop(oldest))
                    held[name] = (a.ids, [[] for _ in a.ids])
                heaps = held[name][1]
                floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
                for i, j, scores in tile(a, b, floor, k):
                    better = scores >= floor[i]
                    push(heaps, i[better], b.ids[j[better]], scores[better], k)
        for name, (ids, heaps) in held.items():
            yield result(name, ids, heaps)

    found = pairs.mapInArrow(run, "dim long, block long, place long, query_id long, vec_id long, score double")
    # A query is told by its place in its block: several may have one id.
    best = found.selectExpr("*", "row_number() OVER (PARTITION BY dim, block, place ORDER BY score DESC, vec_id) AS rank").filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
