"""Mixing sources to target weights, with exact budgets in words.

Every document gets a hash-random key. Within its source documents are ordered by key; ranges of keys are the units of work: a
source has as many ranges as its rows need, so a source with a third of all rows is spread like the others. Sums per range give
each range its start, a window inside a range the rest, and together the words before each document. A budget of several times
the source's words repeats whole epochs; the last one is cut at the exact word.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a source, ordered last; a source without
words has target 0; rows equal in key, size and text are ordered arbitrarily among themselves, which leaves the result as it is; an empty
table gives an empty result; further columns are returned as they are, but for those named like a result, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexigauge.sources.scratch import materialize

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
RANGE_ROWS = 2_000
RESULTS = ("size", "source_size", "target", "taken")
_GAP, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Runs without ASCII white space. A run ends where white space follows it, or at the end."""
    value = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(value, F.lit(_WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, rows) with `target`: shares of `share` times all words by weight, none above `most` times its source.

    What a source at its limit leaves is shared among the others by weight, until none is above. That is one level t with
    target = min(limit, t * weight); a running sum over the sources in order of limit / weight finds it. The table has a row per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    table = sources.withColumn("weight", weight).withColumn("limit", most * F.col("source_size").cast("double"))
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    table = (
        table.withColumn("total", share * F.sum("source_size").over(every).cast("double"))
        .withColumn("full_before", F.coalesce(F.sum("limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("open_weight"))
        # Up to the first source whose limit is above the level, sources are at their limit.
        .withColumn("t", F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(every))
    )
    return table.select(
        "source", "source_size", "rows", F.coalesce(F.least("limit", F.col("t.level") * F.col("weight")), "limit").alias("target")
    )


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: Sequence[int] = WEIGHTS,
    share: float = SHARE, most: int = MOST, seed: str = "mix", keep: list[str] | None = None,
) -> DataFrame:
    """`docs` (or its columns `keep`) with size, source_size, target and taken: the words that the mix takes of the document.

    Each source's `taken` add up to its target, rounded down.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    size = word_count(text)
    rank = F.xxhash64(F.col(key), F.lit(seed))
    narrow = docs.select(
        *columns, F.col(source).alias("_source"), size.alias("size"), rank.alias("_rank"),
        F.xxhash64(F.col(key), F.col(text)).alias("_tie"),
    )
    narrow = materialize(narrow, "sizes")
    sums = narrow.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goals = materialize(targets(sums, weights, share, most), "targets")
    n_sources = goals.count()
    goals = goals.select(
        F.col("source").alias("_s"), "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("rows") / RANGE_ROWS)).alias("_ranges"),
    )
    if n_sources <= 100_000:  # one small row per source
        goals = F.broadcast(goals)
    # A range is an interval of the hash: the hash as a share of its whole span, times the number of ranges.
    unit = (F.shiftrightunsigned("_rank", 11).cast("double")) / float(1 << 53)
    ranged = narrow.join(goals, narrow["_source"].eqNullSafe(goals["_s"])).withColumn(
        "_range", F.least(F.floor(unit * F.col("_ranges")), F.col("_ranges") - 1)
    )
    per_range = ranged.groupBy("_s", "_range").agg(F.sum("size").alias("_words"))
    before = per_range.withColumn(
        "_start", F.sum("_words").over(W.partitionBy("_s").orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_words")
    ).select(F.col("_s").alias("_s2"), F.col("_range").alias("_range2"), "_start")
    inside = W.partitionBy("_s", "_range").orderBy(F.shiftrightunsigned("_rank", 1), "_rank", "_tie", "size").rowsBetween(W.unboundedPreceding, 0)
    summed = ranged.withColumn("_sum", F.sum("size").over(inside) - F.col("size"))
    placed = summed.join(before, summed["_s"].eqNullSafe(before["_s2"]) & (summed["_range"] == before["_range2"]))
    first = F.col("_start") + F.col("_sum")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - first))
    return placed.withColumn("taken", taken.cast("long")).select(*columns, *RESULTS)


def draw(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The documents of the mix: one row per time a document is taken; the one that a budget cuts ends at its last word taken.

    Rows of a repeated document are equal. The columns of `mix` are dropped.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest("size", F.lit(1)))).otherwise(0)
    part = F.col("taken") - whole * F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"{_GAP}*{_WORD}"), F.lit(0)), 1, F.greatest("_n", F.lit(1)).cast("int")), "")
    times = F.concat(F.array_repeat(F.lit(0).cast("long"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    names = [c for c in mixed.columns if c not in RESULTS]
    rows = mixed.filter("taken > 0").withColumn("_n", F.explode(times))
    return rows.withColumn(text, F.when(F.col("_n") > 0, head).otherwise(F.col(text))).select(*names)
