"""Ranks inside groups that may be far too large for one task, and the splits built on them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigauge.config import FOLDS, SEED, TEST_SHARE

# md5 prefix length that names a bucket: 16**3 evenly filled buckets per group.
BUCKET_DIGITS = 3


def shuffle_key(text: Column, seed: int = SEED) -> Column:
    """A reproducible random order of texts (or of their hashes), the same in every engine."""
    return F.coalesce(F.md5(F.concat(F.lit(f"{seed}:"), text)), F.lit(""))


def with_shuffled_rank(df: DataFrame, group: str, key: Column, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Add `rank` (from 1) and `group_rows`: the position of each row in its group by the hex key `key`.

    The key's prefix splits a group into even buckets. Rows are ranked inside (group, bucket); the
    number of rows in earlier buckets, summed over the small table of bucket counts, is added. The
    sorts are bounded by the bucket, not by the group, and the result is exact.
    """
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    counts = keyed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    offsets = counts.select(
        group,
        "_bucket",
        (F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("group_rows"),
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_key")
    return (
        keyed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [group, "_bucket"])
        .withColumn("rank", F.col("_before") + F.col("_inside"))
        .drop("_key", "_bucket", "_before", "_inside")
    )


def stratified_folds(
    df: DataFrame, group: str, folds: int = FOLDS, seed: int = SEED, text: str = "text_hash", exact: bool = True
) -> DataFrame:
    """Add `fold` in 0..folds-1, balanced inside every group.

    Exact: fold sizes inside a group differ by at most one. Otherwise the fold is a hash of the text,
    which needs no shuffle and is balanced up to sampling noise.
    """
    if not exact:
        return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.col(text)), F.lit(folds)).cast("int"))
    ranked = with_shuffled_rank(df, group, shuffle_key(F.col(text), seed))
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int")).drop("rank", "group_rows")


def split_quotas(counts: DataFrame, group: str, share: float = TEST_SHARE) -> DataFrame:
    """(group, quota) from (group, n): ceil(share * total) test rows by largest remainder.

    `counts` has one row per group, so its windows are small.
    """
    everything = Window.partitionBy(F.lit(0))
    by_remainder = everything.orderBy(F.desc("_rest"), group)
    return (
        counts.withColumn("_ideal", F.ceil(F.lit(share) * F.sum("n").over(everything)) * F.col("n") / F.sum("n").over(everything))
        .withColumn("_base", F.floor("_ideal"))
        .withColumn("_rest", F.round(F.col("_ideal") - F.col("_base"), 9))
        .withColumn(
            "_spare",
            F.ceil(F.lit(share) * F.sum("n").over(everything)) - F.sum("_base").over(everything),
        )
        .withColumn("quota", F.col("_base") + F.when(F.row_number().over(by_remainder) <= F.col("_spare"), 1).otherwise(0))
        .select(group, "quota")
    )


def stratified_split(
    df: DataFrame, group: str, share: float = TEST_SHARE, seed: int = SEED, text: str = "text_hash"
) -> DataFrame:
    """Add `split` ('train' or 'test'); every group gives its share of the test rows."""
    ranked = with_shuffled_rank(df, group, shuffle_key(F.col(text), seed))
    quotas = split_quotas(df.groupBy(group).agg(F.count(F.lit(1)).alias("n")), group, share)
    return (
        ranked.join(quotas, group)
        .withColumn("split", F.when(F.col("rank") <= F.col("quota"), "test").otherwise("train"))
        .drop("rank", "group_rows", "quota")
    )


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first `n` rows of each group. A small `n` is applied before the shuffle as well."""
    by = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_pos", F.row_number().over(by)).where(F.col("_pos") <= n).drop("_pos")


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int, spread: Column, buckets: int = 256
) -> DataFrame:
    """The first `n` rows of each group for a large `n`: first inside hash buckets, then among the survivors.

    The last sort sees at most `buckets * n` rows of a group, whatever its size. Exact.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(buckets)))
    return first_rows(first_rows(salted, [*group, "_salt"], order, n), group, order, n).drop("_salt")
