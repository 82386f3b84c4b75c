"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns points on a ring of hashes; a document belongs to the arc that its key's hash falls in, and the arc to the
shard whose point ends it. Shards have capacities that add up to the number of rows and differ by one at most. A shard takes
rows of its own arcs in ring order while it has room; what overflows continues clockwise to the next point whose shard has room.
So row counts differ by one at most, and most rows stay where the plain ring puts them when a shard is added.

Only counts leave the scan: rows per cell, a cell being a slice of an arc. The places of the arcs' rows are worked out on the driver from a count
per arc, of which there are shards * points whatever the input. Within its cell a row gets its rank by a window, the arc's
earlier cells shift it, and the piece of the arc it falls in tells shard and slot.

Defined cases: null texts have no bytes; a null key hashes like any other value; rows of one key lie on one arc, in any order among
themselves where there are more than 2 * CELL_ROWS of them; an empty table gives an empty result; further columns are returned as they are, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexigauge.functions.exprs import small
from lexigauge.sources.scratch import materialize

SHARDS, POINTS = 16, 64
CELL_ROWS = 20_000
TILE_BITS = 12
RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_TOP = 1 << 53


def ring(n: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(point, shard) in ring order. The points of a shard do not depend on how many shards there are."""
    out = set()
    for shard in range(n):
        for i in range(points):
            x = (shard * 1_000_003 + i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
            for _ in range(3):  # a multiply-and-shift mix
                x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 % (1 << 64)
            out.add(((x ^ (x >> 27)) >> 11, shard))
    return sorted(out)


def pieces(counts: Sequence[int], owners: Sequence[int], n: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of every piece of an arc, from rows per arc in ring order."""
    total = sum(counts)
    room = [total // n + (s < total % n) for s in range(n)]
    used = [0] * n
    out = []

    def take(arc: int, first: int, stop: int, shard: int) -> int:
        end = first + min(stop - first, room[shard] - used[shard])
        if end > first:
            out.append((arc, first, end, shard, used[shard]))
            used[shard] += end - first
        return end

    left = [(arc, take(arc, 0, count, owners[arc])) for arc, count in enumerate(counts)]
    for arc, first in left:
        step = arc
        while first < counts[arc]:
            step = (step + 1) % len(counts)
            first = take(arc, first, counts[arc], owners[step])
    return out


def segments(ends: Sequence[int]) -> list[tuple[int, int, int, int, int, int]]:
    """(tile, arc, above, upto, shift, span): where hashes of a tile, above < hash <= upto, lie on arcs; hash - shift is the offset in one.

    Arc i ends at point i. What lies behind the last point belongs to arc 0, before the hashes up to point 0.
    """
    whole = [(i, ends[i - 1], ends[i], ends[i - 1], ends[i] - ends[i - 1]) for i in range(1, len(ends))]
    span = ends[0] - ends[-1] + _TOP
    whole += [(0, ends[-1], _TOP - 1, ends[-1], span), (0, -1, ends[0], ends[-1] - _TOP, span)]
    width = 53 - TILE_BITS
    return [(tile, *part) for part in whole if part[2] > part[1] for tile in range((part[1] + 1) >> width, (part[2] >> width) + 1)]


def hash53(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit("ring")), 11)


def shards(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = SHARDS, points: int = POINTS, keep: Sequence[str] | None = None
) -> DataFrame:
    """`docs` (or its columns `keep`) with size, text_crc32, law `rows`, shard, slot and grown_shard (null under this law)."""
    columns = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # Own columns have names with a prefix: those of `docs` may have any.
    rows = materialize(docs.select(
        *columns, (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), hash53(key).alias("_ring_hash"),
        F.xxhash64(F.col(key), F.col(text)).alias("_ring_tie"), F.monotonically_increasing_id().alias("_ring_no"),
    ), "sizes")
    points_of = ring(n, points)
    ends, owners = [p for p, _ in points_of], [s for _, s in points_of]
    spark = docs.sparkSession
    total = rows.count()
    cells = max(1, -(-4 * total // (CELL_ROWS * len(ends))))
    names = [f"_ring_{c}" for c in ("tile", "arc", "above", "upto", "shift", "span")]
    table = spark.createDataFrame(segments(ends), ", ".join(f"{c} {'int' if c == '_ring_arc' else 'long'}" for c in names))
    # One or two segments per tile of the ring, so a table of fixed size.
    at = F.col("_ring_hash")
    ringed = rows.join(F.broadcast(table), (F.shiftright(at, 53 - TILE_BITS) == F.col("_ring_tile")) & (at > F.col("_ring_above")) & (at <= F.col("_ring_upto")))
    ringed = ringed.withColumn("_ring_offset", at - F.col("_ring_shift")).withColumn(
        "_ring_cell", F.least(F.floor(F.col("_ring_offset").cast("double") / F.col("_ring_span") * cells), F.lit(cells - 1)).cast("int")
    ).drop("_ring_tile", "_ring_above", "_ring_upto", "_ring_shift", "_ring_span")
    # Many rows of one key, or of none, lie in one cell. It is cut by the texts and the rows' numbers.
    full = ringed.groupBy("_ring_arc", "_ring_cell").agg(F.count(F.lit(1)).alias("_ring_n")).filter(F.col("_ring_n") > 2 * CELL_ROWS)
    full = materialize(full.select("_ring_arc", "_ring_cell", F.ceil(F.col("_ring_n") / CELL_ROWS).alias("_ring_parts")), "full_cells")
    cut = ringed.join(small(full, full.count()), ["_ring_arc", "_ring_cell"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("_ring_tie", "_ring_no"), F.col("_ring_parts")), F.lit(0))
    ringed = cut.withColumn("_ring_part", part).drop("_ring_parts")
    cell = ["_ring_arc", "_ring_cell", "_ring_part"]
    per_cell = materialize(ringed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_ring_n")), "cells")
    upto = W.partitionBy("_ring_arc").orderBy("_ring_cell", "_ring_part").rowsBetween(W.unboundedPreceding, 0)
    before = per_cell.withColumn("_ring_before", F.sum("_ring_n").over(upto) - F.col("_ring_n")).drop("_ring_n")
    counts = [0] * len(ends)
    for row in per_cell.groupBy("_ring_arc").agg(F.sum("_ring_n").alias("n")).collect():  # a row per arc
        counts[row["_ring_arc"]] = row["n"]
    parts = spark.createDataFrame(pieces(counts, owners, n), "_ring_in int, _ring_first long, _ring_stop long, shard int, _ring_slot long")
    inside = W.partitionBy(*cell).orderBy("_ring_offset", "_ring_tie", "size", "text_crc32")
    ranked = ringed.withColumn("_ring_rank", F.row_number().over(inside)).join(before, cell)
    rank = F.col("_ring_rank")
    ranked = ranked.withColumn("_ring_rank", rank - 1 + F.col("_ring_before"))
    # At most one piece per arc and shard: a table of fixed size.
    placed = ranked.join(F.broadcast(parts), (F.col("_ring_arc") == F.col("_ring_in")) & (rank >= F.col("_ring_first")) & (rank < F.col("_ring_stop")))
    return placed.select(
        *columns, "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_ring_slot") + rank - F.col("_ring_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
