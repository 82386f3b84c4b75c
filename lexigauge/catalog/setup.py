"""How the given tables are read as a labelled corpus: parameters shared by queries and SQL."""

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigauge.config import MAX_FEATURES, SIGNALS, STOP_WORDS, WEB_WORDS
from lexigauge.operators.vocab import select_vocabulary, term_statistics, with_idf
from lexigauge.operators.weights import signal_scaler
from lexigauge.plans import corpus as plans
from lexigauge.plans.fit import Model
from lexigauge.sources.tables import group_dimension, labelled_documents, spread

# (origin, label, group, order, display name)
GROUPS = (
    ("en", 1, "en_toxic", 0, "English toxic"),
    ("en", 0, "en_clean", 1, "English clean"),
    ("other", 1, "other_toxic", 2, "Other toxic"),
    ("other", 0, "other_clean", 3, "Other clean"),
)
# Lexicons with terms that occur in the given texts.
LEXICONS: Mapping[str, Sequence[str]] = {
    "urgency": ("worthless", "clown", "idiot", "pathetic", "trash", "stupid", "disgusting", "moron", "scum", "loser"),
    "cta": ("license", "version", "here"),
}
STOP = (*STOP_WORDS, *WEB_WORDS)

# A weight table that needs no fit, so that scoring can be checked against SQL: the features come from
# the data, the coefficients follow from their position.
FIXED_INTERCEPT = -0.25


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(spark: SparkSession, sf_dir: str, table: str, *columns) -> DataFrame:
    """The columns of a table with long texts, as evenly spread as the cores can use."""
    return spread(read(spark, sf_dir, table).select(*columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id", F.col("text").alias("raw"))


def origin():
    return F.when(F.col("lang") == "en", "en").otherwise("other")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), origin(), "toxic", group_dimension(spark, GROUPS)
    )


def distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.distinct_documents(corpus(spark, sf_dir))


def all_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents whether they have a label or not: counting terms needs none."""
    return plans.distinct_documents(documents(spark, sf_dir), ("doc_id",))


features = partial(plans.features, lexicons=LEXICONS)


def fixed_model(docs: DataFrame) -> Model:
    """From a feature table: its vocabulary, idf and scaler with coefficients by position."""
    terms = with_idf(select_vocabulary(term_statistics(docs)), docs).withColumn(
        "coef", (F.col("idx") % 7 - 3) * 0.5
    )
    numeric = signal_scaler(docs).withColumn("coef", (F.col("pos") - 2) * 0.2)
    meta = docs.sparkSession.createDataFrame([(FIXED_INTERCEPT,)], "intercept double")
    return Model.from_tables(terms, numeric, meta, MAX_FEATURES + len(SIGNALS) + 1)
