"""Corpora from tables: (doc_id, raw, y, origin, grp, grp_order)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SMALL_SPLITS = 16
GROUP_SCHEMA = "origin string, y int, grp string, grp_order int, grp_name string"


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input of a few splits, such as a single small file.

    An input of SMALL_SPLITS splits or more passes without a shuffle, however many cores there are.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df if splits >= min(cores, SMALL_SPLITS) else df.repartition(min(cores, SMALL_SPLITS))


def group_dimension(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """The fixed table of groups; a group is an origin with a class."""
    return spark.createDataFrame(list(rows), GROUP_SCHEMA)


def with_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Attach group columns by (origin, y). `groups` is a hand-written list, so it is broadcast."""
    return docs.join(F.broadcast(groups), ["origin", "y"])


def labelled_documents(
    documents: DataFrame, labels: DataFrame, origin: Column, label: str, groups: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents that have a label, with origin and group. Only the columns used are read."""
    texts = spread(documents.select(key, F.coalesce(F.col(text), F.lit("")).alias("raw"), origin.alias("origin")))
    joined = texts.join(labels.select(key, F.col(label).cast("int").alias("y")), key)
    return with_groups(joined, groups)
