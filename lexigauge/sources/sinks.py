"""Where models and statistics go, and where models come back from."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigauge.config import LEXICONS, SIGNALS
from lexigauge.operators.weights import INTERCEPT
from lexigauge.plans.fit import Model

WEIGHT_DIGITS = 6


def save_model(model: Model, path: str, lexicons: Mapping[str, Sequence[str]] = LEXICONS, number: int = 0) -> None:
    """Write one model as tables: terms, numeric, meta, lexicon. Floats keep six decimals."""
    spark = model.weights.sparkSession
    own = model.weights.where(F.col("model") == number)
    rounded = lambda *names: [F.round(n, WEIGHT_DIGITS).alias(n) for n in names]
    own.where("is_term").select(
        F.col("key").alias("term"), (F.col("slot") - len(SIGNALS)).alias("idx"), *rounded("idf", "coef")
    ).write.mode("overwrite").parquet(f"{path}/terms")
    own.where(~F.col("is_term") & F.col("slot").isNotNull()).select(
        F.expr("substring(key, 2, length(key) - 2)").alias("name"), F.col("slot").alias("pos"), *rounded("mean", "std", "coef")
    ).write.mode("overwrite").parquet(f"{path}/numeric")
    own.where(F.col("key") == INTERCEPT).select(F.round("coef", WEIGHT_DIGITS).alias("intercept")).write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")
    entries = [(kind, term, i) for kind, terms in lexicons.items() for i, term in enumerate(terms)]
    spark.createDataFrame(entries, "kind string, term string, pos int").write.mode("overwrite").parquet(f"{path}/lexicon")


def load_model(spark: SparkSession, path: str) -> tuple[Model, dict[str, list[str]]]:
    """The model and its lexicons. The number of rows is read off, so a join knows if it may broadcast."""
    terms = spark.read.parquet(f"{path}/terms")
    numeric = spark.read.parquet(f"{path}/numeric")
    meta = spark.read.parquet(f"{path}/meta")
    model = Model.from_tables(terms, numeric, meta, rows=terms.count() + len(SIGNALS) + 1)
    lexicons: dict[str, list[str]] = {}
    for r in spark.read.parquet(f"{path}/lexicon").orderBy("kind", "pos").collect():
        lexicons.setdefault(r["kind"], []).append(r["term"])
    return model, lexicons


def save_stats(stats: DataFrame, path: str) -> None:
    """The long table of published numbers as JSON lines."""
    stats.write.mode("overwrite").json(path)
