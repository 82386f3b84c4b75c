"""Whole runs: published statistics, parity of a stored model, and the training run that writes both."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigauge.config import (
    FOLDS, INVERSE_REGULARISATION, LEXICONS, MAX_FEATURES, SEED, STOP_WORDS, TEST_SHARE, WEB_WORDS,
)
from lexigauge.functions.clean import clean_text
from lexigauge.functions.signals import with_signals
from lexigauge.operators import profile, rank, score
from lexigauge.operators.dedup import require_consistent_labels, require_rows
from lexigauge.plans import evaluate
from lexigauge.plans.corpus import distinct_documents, features
from lexigauge.plans.fit import Model
from lexigauge.sources import sinks
from lexigauge.sources.scratch import materialize, new_path
from lexigauge.streaming.score import score_texts

# Raw texts for what this engine could get wrong: hosts of many labels or with empty ones, line ends that only some readers split
# at, letters written with combining marks, characters of two UTF-16 units, regex syntax, and one text twice.
EDGE_TEXTS = (
    "see " + "a." * 150 + "org/now and b..com",
    "one\x0btwo\x1cthree four, five,",
    "café Ångstrom ﬁne ½",
    "\U0001f600\U0001f600 twice! twice? \U0001d504",
    r"\Qquoted\E (group) [class] $1 \\ end",
    "the same text",
    "the same text",
)


def statistics(
    corpus: DataFrame, documents: DataFrame, lexicons: Mapping[str, Sequence[str]] = LEXICONS,
    stop_words: Sequence[str] = (*STOP_WORDS, *WEB_WORDS), group: str = "grp",
) -> DataFrame:
    """(metric, key, group, value): sizes, profile, lexicon rates and top words of every group.

    The distinct documents are read once; everything derives from their marks.
    """
    marked = materialize(profile.marks(with_signals(documents, lexicons), lexicons["urgency"], group=group), "marks")
    distinct = marked.where("kind = 'length'").groupBy(group).agg(F.sum("n").alias("distinct_texts"))
    rows = corpus.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
    return profile.stats_table(
        profile.marked_profile(marked, group),
        profile.marked_rates(marked, lexicons["urgency"], group),
        profile.marked_words(marked, stop_words, group=group),
        rows.join(distinct, group, "left").na.fill(0, ["distinct_texts"]),
        group,
    )


def signal_reference(reference: DataFrame, label: str = "y") -> dict[str, tuple[float, float]]:
    """What is typical of either class, for `document_report`, from the two rows of `class_reference`."""
    rows = {r[label]: r for r in reference.collect()}
    columns = {"urgency": "urg_any", "cta": "cta_any", "urls": "urls", "length": "median_words", "caps": "caps"}
    return {name: (rows[1][c], rows[0][c]) for name, c in columns.items()}


def parity(
    spark: SparkSession, texts: DataFrame, model: Model, lexicons: Mapping[str, Sequence[str]], keys: Sequence[str]
) -> DataFrame:
    """(keys..., p, p_stored, diff): scores of raw texts before and after storing the model."""
    path = new_path(spark, "parity-model")
    sinks.save_model(model, path, lexicons)
    loaded, own = sinks.load_model(spark, path)
    both = [
        score_texts(texts.withColumn("doc_id", F.struct(*keys)), m, lx).select(F.col("doc_id.*"), F.col("p").alias(name))
        for m, lx, name in ((model, lexicons, "p"), (loaded, own, "p_stored"))
    ]
    return both[0].join(both[1], list(keys)).withColumn("diff", F.abs(F.col("p") - F.col("p_stored")))


def worst_difference(expected: DataFrame, model: Model, lexicons: Mapping[str, Sequence[str]] = LEXICONS) -> float:
    """Largest difference between stored probabilities (text, p) and the model's."""
    keyed = expected.select(F.struct("text", F.col("p").alias("stored")).alias("doc_id"), F.col("text").alias("raw"))
    scored = score_texts(keyed, model, lexicons)
    return scored.agg(F.max(F.abs(F.col("p") - F.col("doc_id.stored")))).first()[0]


def parity_texts(spark: SparkSession, predicted: DataFrame, raws: DataFrame, per_group: int = 2) -> DataFrame:
    """Raw texts to store with a model: the first test documents of each group, and the edge cases."""
    sampled = rank.first_rows(predicted.select("doc_id", "grp"), ["grp"], ["doc_id"], per_group)
    edges = spark.createDataFrame([(t,) for t in EDGE_TEXTS], "text string")
    return raws.join(F.broadcast(sampled.select("doc_id")), "doc_id").select(F.col("raw").alias("text")).unionByName(edges)


def training_run(
    corpus: DataFrame, out: str, lexicons: Mapping[str, Sequence[str]] = LEXICONS,
    stop_words: Sequence[str] = (*STOP_WORDS, *WEB_WORDS), max_features: int = MAX_FEATURES,
    C: float = INVERSE_REGULARISATION, folds: int = FOLDS, share: float = TEST_SHARE, seed: int = SEED,
    expected_rows: dict[str, int] | int | None = None, transfer_pairs: Sequence[tuple[str, str]] = (), **fit,
) -> dict[str, DataFrame]:
    """Everything from a loaded corpus (doc_id, raw, y, origin, grp, grp_order) to a stored model and statistics.

    Writes `<out>/model`, `<out>/stats`; returns the reports by name. `transfer_pairs` lists (origin to fit on, origin to test
    on); without any there is no transfer report.
    """
    spark = corpus.sparkSession
    loaded = materialize(corpus, "corpus")
    if expected_rows is not None:
        require_rows(loaded, "grp", expected_rows)
    documents = materialize(distinct_documents(loaded, keep_raw=True), "documents")
    require_consistent_labels(loaded.withColumn("text", clean_text(F.col("raw"))))
    ready = materialize(features(documents, lexicons).drop("raw", "text", "low"), "features")
    options = {"max_features": max_features, "C": C, **fit}

    cv = evaluate.cross_validate(ready, folds, seed, **options)
    model, predicted, held_out = evaluate.hold_out(ready, share, seed, **options)
    transfer = {"transfer": evaluate.cross_origin(ready, transfer_pairs, **options)} if transfer_pairs else {}

    sinks.save_model(model, f"{out}/model", lexicons)
    tests = parity_texts(spark, predicted, documents.select("doc_id", "raw"))
    keyed = tests.select(F.col("text").alias("doc_id"), F.col("text").alias("raw"))
    score_texts(keyed, model, lexicons).select(
        F.col("doc_id").alias("text"), F.round("p", sinks.WEIGHT_DIGITS).alias("p")
    ).write.mode("overwrite").parquet(f"{out}/model/parity")
    stats = statistics(loaded, documents, lexicons, stop_words)
    sinks.save_stats(stats, f"{out}/stats")
    return {
        "cv": cv, "held_out": held_out, **transfer, "strongest": score.strongest_terms(model.weights),
        "stats": spark.read.schema(stats.schema).json(f"{out}/stats"),
        "parity": spark.read.parquet(f"{out}/model/parity"),
    }
