"""Term statistics, vocabulary and inverse document frequency."""

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigauge.config import MAX_FEATURES, MIN_DOC_FREQ
from lexigauge.functions.exprs import unpack
from lexigauge.functions.terms import term_counts, tokens
from lexigauge.sources.scratch import materialize

#: Hash buckets that occurrences are summed in before terms are counted, and buckets looked into per wanted term.
BUCKETS, TRIED = 1 << 19, 3


def with_term_counts(df: DataFrame, words: Callable[[Column], Column] = tokens) -> DataFrame:
    """Add `counted`: array<struct<term, cnt>> of the words and pairs of `low`. `words` cuts a text into words."""
    return df.withColumn("counted", term_counts(F.col("low"), words))


def document_terms(df: DataFrame, *keys: str) -> DataFrame:
    """Long form (keys..., term, cnt)."""
    long = df.select(*keys, unpack(F.col("counted"))).where(F.col("term").isNotNull())
    return long.withColumn("cnt", F.col("cnt").cast("long"))


def term_statistics(df: DataFrame) -> DataFrame:
    """(term, tf, df): occurrences, and documents with the term.

    Counts are already per document, so one shuffle by term does, and hot terms combine before it.
    """
    return document_terms(df).groupBy("term").agg(F.sum("cnt").alias("tf"), F.count(F.lit(1)).alias("df"))


def select_vocabulary(
    stats: DataFrame, max_features: int = MAX_FEATURES, min_df: int = MIN_DOC_FREQ
) -> DataFrame:
    """(term, idx, tf, df): the most frequent terms of at least `min_df` documents, numbered in term order."""
    kept = stats.where(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(max_features)
    # At most max_features rows are left for this window.
    in_order = Window.partitionBy(F.lit(0)).orderBy("term")
    return kept.select("term", (F.row_number().over(in_order) - 1).alias("idx"), "tf", "df")


def smoothed_idf(n: Column, df: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


def with_idf(vocabulary: DataFrame, docs: DataFrame) -> DataFrame:
    """Add `idf` to a vocabulary, from the number of rows of `docs`, the documents it was selected on."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    return vocabulary.withColumn("idf", smoothed_idf(n, F.col("df")))


def part_statistics(df: DataFrame, part: str, parts: Sequence) -> DataFrame:
    """(term, tf_0, df_0, tf_1, ...): the term statistics of every part, in one pass and one shuffle."""
    return _part_sums(document_terms(df, part), part, parts)


def _part_sums(long: DataFrame, part: str, parts: Sequence) -> DataFrame:
    sums = []
    for i, p in enumerate(parts):
        here = F.col(part) == F.lit(p)
        sums.append(F.sum(F.when(here, F.col("cnt")).otherwise(F.lit(0))).alias(f"tf_{i}"))
        sums.append(F.sum(F.when(here, F.lit(1)).otherwise(F.lit(0))).alias(f"df_{i}"))
    return long.groupBy("term").agg(*sums)


def frequent_terms(
    df: DataFrame, part: str, parts: Sequence, groups: Sequence[Sequence[int]], max_features: int = MAX_FEATURES, min_df: int = MIN_DOC_FREQ
) -> DataFrame:
    """`part_statistics` of some terms: of all that can be among the `max_features` most frequent of a group. Exact.

    A group is a list of places in `parts`; terms of fewer than `min_df` of its documents do not count. Nearly all terms of a large
    corpus are rare, so occurrences are first summed in hash buckets: a term has at most its bucket's. Only the terms of the fullest
    buckets are counted by their strings. If a group's last wanted term is more frequent than every bucket left out is full, no
    other term can take its place; if not, all buckets as full as that term are counted. `df` is read more than once: hand over
    a materialized table.
    """
    spark = df.sparkSession
    long = document_terms(df, part).withColumn("_bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)))
    total = [F.sum(F.when(F.col(part) == F.lit(p), F.col("cnt")).otherwise(F.lit(0))).alias(f"n_{i}") for i, p in enumerate(parts)]
    held = long.groupBy("_bucket").agg(*total).toArrow()
    names = held["_bucket"].to_numpy()
    full = [sum(held[f"n_{i}"].to_numpy() for i in group) for group in groups]
    most = TRIED * max_features
    left = [int(np.partition(n, len(n) - most - 1)[len(n) - most - 1]) if len(n) > most else 0 for n in full]

    def counted(bounds: Sequence[int]) -> DataFrame:
        if not all(bounds):
            return _part_sums(long, part, parts)
        chosen = np.logical_or.reduce([n > bound for n, bound in zip(full, bounds, strict=True)])
        wanted = spark.createDataFrame(pa.table({"_bucket": names[chosen]}))
        return _part_sums(long.join(F.broadcast(wanted), "_bucket", "left_semi"), part, parts)

    if not all(left):
        return counted(left)
    found = materialize(counted(left).where(_over(groups, "df", min_df)), "terms")
    last = [_last_wanted(found, group, max_features, min_df) for group in groups]
    if all(n > bound for n, bound in zip(last, left, strict=True)):
        return found
    return counted([max(n - 1, 0) if n <= bound else bound for n, bound in zip(last, left, strict=True)])


def _summed(what: str, group: Sequence[int]) -> Column:
    return sum((F.col(f"{what}_{i}") for i in group[1:]), F.col(f"{what}_{group[0]}"))


def _over(groups: Sequence[Sequence[int]], what: str, least: int) -> Column:
    return F.greatest(*[_summed(what, g) for g in groups], F.lit(0)) >= least


def _last_wanted(found: DataFrame, group: Sequence[int], max_features: int, min_df: int) -> int:
    """Occurrences of the `max_features`-th term of a group, 0 if it has fewer."""
    kept = found.where(_over([group], "df", min_df)).select(_summed("tf", group).alias("n")).orderBy(F.desc("n")).limit(max_features)
    row = kept.agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("n")).first()
    return row["n"] if row["rows"] == max_features else 0
