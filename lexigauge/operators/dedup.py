"""Exact duplicates: keep the first copy, find label conflicts, audit."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def text_hash(text: Column) -> Column:
    """SHA-256 in hex, empty for null.

    Spark types sha2 as nullable even for a non-null text, and would push "hash is not null" filters,
    with all the cleaning below them, under earlier joins. Saying it is never null avoids that.
    """
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def keep_first(df: DataFrame, order: Sequence[str], text: str | None = "text") -> DataFrame:
    """One row per distinct text, the first by `order`; adds `text_hash`. Without `text` the table has `text_hash` and needs no text.

    `row_number() = 1` is planned with a group limit before the shuffle: a text that makes up a third
    of the table leaves each map task as one row, so no reducer receives all its copies.
    """
    first = Window.partitionBy("text_hash").orderBy(*order)
    return (
        (df if text is None else df.withColumn("text_hash", text_hash(F.col(text))))
        .withColumn("_copy", F.row_number().over(first))
        .where("_copy = 1")
        .drop("_copy")
    )


def label_conflicts(df: DataFrame, text: str | None = "text", label: str = "y") -> DataFrame:
    """(text_hash, lowest, highest) of texts that occur with more than one label. Without `text` the table has `text_hash`."""
    return (
        df.groupBy("text_hash" if text is None else text_hash(F.col(text)).alias("text_hash"))
        .agg(F.min(label).alias("lowest"), F.max(label).alias("highest"))
        .where("lowest <> highest")
    )


def require_consistent_labels(df: DataFrame, text: str = "text", label: str = "y") -> None:
    found = label_conflicts(df, text, label).limit(1).collect()
    if found:
        raise ValueError(f"same text appears with both labels (text hash {found[0]['text_hash']})")


def exact_row(columns: Sequence[str]) -> Column:
    """All values of a row as one string: every value with its length before it, a null as a dash; nothing is rounded."""
    values = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def duplicate_audit(
    df: DataFrame, group: str, row_columns: Sequence[str], text: str = "raw_text", cleaned: str = "text"
) -> DataFrame:
    """Per group: rows, identical rows, identical texts, unique texts, texts left after cleaning.

    The distinct counts run on fixed-size hashes and combine before the shuffle. Two nulls count as
    identical texts, but a null is not a unique text.
    """
    row_hash = F.sha2(exact_row(row_columns), 256)
    slim = df.select(
        group,
        row_hash.alias("row_hash"),
        F.sha2(text, 256).alias("raw_hash"),
        F.sha2(cleaned, 256).alias("clean_hash"),
    )
    return (
        slim.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("row_hash").alias("distinct_rows"),
            F.count_distinct("raw_hash").alias("unique_text"),
            F.max(F.col("raw_hash").isNull().cast("int")).alias("has_null"),
            F.count_distinct("clean_hash").alias("after_cleaning"),
        )
        .select(
            group,
            "n_rows",
            (F.col("n_rows") - F.col("distinct_rows")).alias("identical_rows"),
            (F.col("n_rows") - F.col("unique_text") - F.col("has_null")).alias("identical_text"),
            "unique_text",
            "after_cleaning",
        )
    )


def require_rows(df: DataFrame, group: str, expected: dict[str, int] | int) -> None:
    """Abort unless every group has the expected number of rows."""
    found = {r[group]: r["count"] for r in df.groupBy(group).count().collect()}
    wanted = dict.fromkeys(found, expected) if isinstance(expected, int) else expected
    if found != wanted:
        raise ValueError(f"rows per {group}: expected {wanted}, found {found}")
