"""Sparse document features in long form: term weights and standardised signals joined to a weight table.

A weight table has one row per feature of a model:
    model int, key string, slot int, is_term boolean, idf double, mean double, std double [, coef double]
Signals have keys like '[log_words]' (no term contains a bracket) and the first slots; terms follow.
"""

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from lexigauge.config import SIGNALS
from lexigauge.functions.exprs import small, unpack
from lexigauge.operators import inrow
from lexigauge.operators.inrow import INTERCEPT, VECTOR, lookup_of, signal_key

ROW = "_row"


def sublinear(count: Column) -> Column:
    return 1 + F.log(count)


def scaler() -> list[Column]:
    """Aggregates for the mean and POPULATION deviation of each signal; a deviation of 0 becomes 1."""
    out = []
    for name in SIGNALS:
        deviation = F.stddev_pop(name)
        out.append(F.avg(name).alias(f"mean_{name}"))
        out.append(F.when(deviation == 0, F.lit(1.0)).otherwise(deviation).alias(f"std_{name}"))
    return out


def signal_scaler(df: DataFrame) -> DataFrame:
    """(pos, name, mean, std) of the six signals."""
    cells = F.array(*[
        F.struct(
            F.lit(i).alias("pos"), F.lit(n).alias("name"), F.col(f"mean_{n}").alias("mean"), F.col(f"std_{n}").alias("std")
        )
        for i, n in enumerate(SIGNALS)
    ])
    return df.agg(*scaler()).select(F.inline(cells))


def term_weight_rows(vocabulary: DataFrame, *extra: str) -> DataFrame:
    """Weight-table rows from (model, term, idx, idf), with the columns `extra` behind."""
    return vocabulary.select(
        F.col("model").cast("int").alias("model"),
        F.col("term").alias("key"),
        (F.col("idx") + len(SIGNALS)).cast("int").alias("slot"),
        F.lit(True).alias("is_term"),
        "idf",
        F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("std"),
        *extra,
    )


def signal_weight_rows(scale: DataFrame, *extra: str) -> DataFrame:
    """Weight-table rows from (model, pos, name, mean, std), with the columns `extra` behind."""
    return scale.select(
        F.col("model").cast("int").alias("model"),
        F.concat(F.lit("["), F.col("name"), F.lit("]")).alias("key"),
        F.col("pos").cast("int").alias("slot"),
        F.lit(False).alias("is_term"),
        F.lit(None).cast("double").alias("idf"),
        "mean",
        "std",
        *extra,
    )


def intercept_rows(intercepts: DataFrame) -> DataFrame:
    """Weight-table rows with `coef` from (model, intercept): a feature that is 1 in every document."""
    return intercepts.select(
        F.col("model").cast("int").alias("model"),
        F.lit(INTERCEPT).alias("key"),
        F.lit(None).cast("int").alias("slot"),
        F.lit(False).alias("is_term"),
        F.lit(None).cast("double").alias("idf"),
        F.lit(0.0).alias("mean"),
        F.lit(1.0).alias("std"),
        F.col("intercept").cast("double").alias("coef"),
    )


def weighted_entries(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(model, ROW, keys..., key, slot, is_term, value [, coef]): one row per known feature of a document and model.

    ROW tells the rows of `docs` apart, made where they are scanned: keys may repeat.

    `docs` needs `counted` and the signals; an array column `models` says which models a document belongs
    to (without one, to all of the table). `rows` bounds the weight table, which is broadcast when small,
    so documents are not shuffled, and a document's features are laid out once however many models there
    are. Unknown terms drop out; signals (and the intercept, where the table has one) always match, so
    every document keeps a row. `value` is the term weight before the L2 norm, or the standardised signal.
    """
    own = [(signal_key(n), F.col(n)) for n in SIGNALS] + [(INTERCEPT, F.lit(1.0))]
    entries = F.concat("counted", F.array(*[F.struct(F.lit(k).alias("term"), x.alias("cnt")) for k, x in own]))
    chosen = "models" in docs.columns
    numbered = docs.withColumn(ROW, F.monotonically_increasing_id())
    long = numbered.select(ROW, *keys, *(["models"] if chosen else []), unpack(entries)).withColumnsRenamed({"term": "key", "cnt": "x"})
    known = long.join(small(weights, rows), "key")
    if chosen:
        known = known.where(F.array_contains("models", F.col("model"))).drop("models")
    value = F.when(F.col("is_term"), sublinear(F.col("x")) * F.col("idf")).otherwise((F.col("x") - F.col("mean")) / F.col("std"))
    return known.withColumn("value", value).drop("x", "idf", "mean", "std")


def norm_of(entries_is_term: Column, value: Column) -> Column:
    """L2 norm of the term block of a document as an aggregate; 1 where no term is known."""
    squares = F.sum(F.when(entries_is_term, value * value))
    return F.coalesce(F.when(squares > 0, F.sqrt(squares)), F.lit(1.0))


def tfidf(docs: DataFrame, vocabulary: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """(key, term, weight): L2-normalised sublinear TF-IDF over vocabulary terms. `rows` bounds a vocabulary too large to look up."""
    found = inrow.term_weights(docs, vocabulary, key)
    return joined_tfidf(docs, vocabulary, rows, key) if found is None else found


def joined_tfidf(docs: DataFrame, vocabulary: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """The same for a vocabulary of any size, by a join of terms."""
    known = (
        docs.withColumn(ROW, F.monotonically_increasing_id())
        .select(ROW, key, unpack(F.col("counted")))
        .join(small(vocabulary.select("term", "idf"), rows), "term")
        .withColumn("w", sublinear(F.col("cnt")) * F.col("idf"))
    )
    # A document's entries number at most the vocabulary, so they fit one row.
    per_doc = known.groupBy(ROW, key).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.struct("term", "w")).alias("entries")
    )
    return per_doc.select(key, "norm", F.inline("entries")).select(key, "term", (F.col("w") / F.col("norm")).alias("weight"))


def with_vectors(schema: StructType, name: str = "features") -> StructType:
    """The schema to read a written table with, so that `name`, stored as a struct, is a vector of MLlib."""
    return StructType([StructField(f.name, VectorUDT(), f.nullable) if f.name == name else f for f in schema])


def feature_vectors(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int, max_features: int) -> DataFrame:
    """(model, keys..., features): one sparse vector per document and model, normalised terms and standardised signals.

    `features` is a struct as MLlib stores vectors: write the table and read it with the schema `with_vectors` makes. `keys` are
    carried along; they need not identify a row.
    """
    lookup = lookup_of(weights)
    if lookup is not None:
        return inrow.vectors(docs, lookup, keys, max_features + len(SIGNALS))
    entries = weighted_entries(docs, weights, keys, rows).where(F.col("slot").isNotNull())
    per_doc = entries.groupBy("model", ROW, *keys).agg(
        norm_of(F.col("is_term"), F.col("value")).alias("norm"),
        F.sort_array(F.collect_list(F.struct("slot", "is_term", "value"))).alias("entries"),
    )
    values = F.transform(
        "entries", lambda e: F.when(e["is_term"], e["value"] / F.col("norm")).otherwise(e["value"])
    )
    size = F.lit(max_features + len(SIGNALS))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), size.alias("size"), F.col("entries.slot").alias("indices"), values.alias("values"))
    return per_doc.select("model", *keys, vector.cast(VECTOR).alias("features"))
