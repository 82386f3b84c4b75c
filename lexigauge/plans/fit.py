"""Fitting: vocabulary, scaler and coefficients of one or more models from one pass over the documents."""

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.util import inheritable_thread_target

from lexigauge.config import (
    INVERSE_REGULARISATION, MAX_FEATURES, MAX_ITER, MIN_DOC_FREQ, SIGNALS, TOLERANCE,
)
from lexigauge.operators.rank import top_per_group
from lexigauge.operators.vocab import frequent_terms, smoothed_idf
from lexigauge.operators.weights import (
    feature_vectors, intercept_rows, scaler, signal_weight_rows, term_weight_rows, with_vectors,
)
from lexigauge.sources.scratch import materialize, small_batches

FITS_AT_ONCE = 8
ROWS_PER_TASK = 20_000


@dataclass(frozen=True)
class Trial:
    """One model: fitted on the documents of the `train` parts, tested on those of the `test` parts."""

    model: int
    name: str
    train: tuple
    test: tuple = ()


@dataclass(frozen=True)
class Model:
    """A weight table with coefficients (see operators.weights) and a bound on its rows."""

    weights: DataFrame
    rows: int

    @staticmethod
    def from_tables(terms: DataFrame, numeric: DataFrame, meta: DataFrame, rows: int) -> "Model":
        """From (term, idx, idf, coef), (name, pos, mean, std, coef) and (intercept)."""
        weights = (
            term_weight_rows(terms.withColumn("model", F.lit(0)), "coef")
            .unionByName(signal_weight_rows(numeric.withColumn("model", F.lit(0)), "coef"))
            .unionByName(intercept_rows(meta.withColumn("model", F.lit(0))))
        )
        return Model(weights, rows)


def trial_vocabularies(
    docs: DataFrame, part: str, trials: Sequence[Trial], sizes: dict[int, int],
    max_features: int = MAX_FEATURES, min_df: int = MIN_DOC_FREQ,
) -> DataFrame:
    """(model, term, idx, tf, df, idf) of every trial, each from its training parts only.

    Terms are counted per part for all trials; a trial's counts are sums over its parts.
    """
    parts = sorted({p for t in trials for p in t.train})
    groups = [[parts.index(p) for p in t.train] for t in trials]
    stats = frequent_terms(docs.where(F.col(part).isin(parts)), part, parts, groups, max_features, min_df)

    def total(what, trial):
        return reduce(lambda a, b: a + b, [F.col(f"{what}_{parts.index(p)}") for p in trial.train])

    per_trial = F.array(*[
        F.struct(
            F.lit(t.model).alias("model"), total("tf", t).alias("tf"), total("df", t).alias("df"),
            F.lit(sizes[t.model]).alias("n"),
        )
        for t in trials
    ])
    # A term too rare overall is too rare for every trial; most terms end here.
    overall = reduce(lambda a, b: a + b, [F.col(f"df_{i}") for i in range(len(parts))])
    candidates = stats.where(overall >= min_df).select("term", F.inline(per_trial)).where(F.col("df") >= min_df)
    kept = top_per_group(candidates, ["model"], [F.desc("tf"), "term"], max_features, F.col("term"))
    # At most max_features rows per model are left for this window.
    in_order = Window.partitionBy("model").orderBy("term")
    return kept.select(
        "model", "term", (F.row_number().over(in_order) - 1).alias("idx"), "tf", "df",
        smoothed_idf(F.col("n"), F.col("df")).alias("idf"),
    )


def trial_scalers(docs: DataFrame, part: str, trials: Sequence[Trial]) -> dict[int, dict]:
    """Training size, and mean and deviation of each signal, per trial; one pass, a few numbers."""
    shares = assign_trials(docs, part, trials, "train").select(F.explode("models").alias("model"), *SIGNALS)
    rows = shares.groupBy("model").agg(F.count(F.lit(1)).alias("n"), *scaler()).collect()
    return {r["model"]: {"n": r["n"], "signals": [(r[f"mean_{s}"], r[f"std_{s}"]) for s in SIGNALS]} for r in rows}


def assign_trials(docs: DataFrame, part: str, trials: Sequence[Trial], role: str) -> DataFrame:
    """Add `models`, the trials that have a document's part in `role`; documents of no trial drop out."""
    wanted: dict = {}
    for t in trials:
        for p in getattr(t, role):
            wanted.setdefault(p, []).append(t.model)
    cases = [F.when(F.col(part) == p, F.array(*map(F.lit, models))) for p, models in wanted.items()]
    return docs.where(F.col(part).isin(list(wanted))).withColumn("models", F.coalesce(*cases))


def trial_weights(
    docs: DataFrame, part: str, trials: Sequence[Trial], max_features: int = MAX_FEATURES, min_df: int = MIN_DOC_FREQ
) -> tuple[Model, dict[int, int]]:
    """The weight table of all trials without coefficients, and the number of training documents of each."""
    spark = docs.sparkSession
    scales = trial_scalers(docs, part, trials)
    sizes = {m: s["n"] for m, s in scales.items()}
    vocabulary = trial_vocabularies(docs, part, trials, sizes, max_features, min_df)
    scale_rows = spark.createDataFrame(
        [(m, i, n, *s["signals"][i]) for m, s in scales.items() for i, n in enumerate(SIGNALS)],
        "model int, pos int, name string, mean double, std double",
    )
    weights = materialize(
        term_weight_rows(vocabulary).unionByName(signal_weight_rows(scale_rows)), "weights"
    )
    return Model(weights, len(trials) * (max_features + len(SIGNALS) + 1)), sizes


def fits_at_once(rows: int, cores: int) -> int:
    """How many fits of so many rows run side by side: as many as fill the cores, and one more for the pauses between their passes.

    A fit keeps its rows in memory until it ends. One with more tasks than there are cores runs alone, so those kept at a time
    are the rows of one fit, or 2 * ROWS_PER_TASK a core.
    """
    return min(FITS_AT_ONCE, 1 + cores // max(_tasks(rows), 1))


def _tasks(rows: int) -> int:
    return -(-rows // ROWS_PER_TASK)


def fixed_trials(
    docs: DataFrame, part: str, trials: Sequence[Trial], max_features: int = MAX_FEATURES, min_df: int = MIN_DOC_FREQ,
    coef: Column | None = None, intercept: float = 0.0,
) -> Model:
    """All trials with given coefficients in place of fitted ones: `coef`, of the columns of a weight table (0, if None).

    Everything but the optimiser is as in `fit_trials`, so that what is done with models can be checked without one.
    """
    bare, sizes = trial_weights(docs, part, trials, max_features, min_df)
    constants = docs.sparkSession.createDataFrame([(m, float(intercept)) for m in sizes], "model int, intercept double")
    weights = bare.weights.withColumn("coef", F.lit(0.0) if coef is None else coef.cast("double"))
    return Model(materialize(weights.unionByName(intercept_rows(constants)), "model"), bare.rows)


def fit_trials(
    docs: DataFrame, part: str, trials: Sequence[Trial], max_features: int = MAX_FEATURES,
    C: float = INVERSE_REGULARISATION, max_iter: int = MAX_ITER, tol: float = TOLERANCE, min_df: int = MIN_DOC_FREQ,
) -> Model:
    """Fit all trials. `docs` has `doc_id`, `y`, `part`, the signals and `counted`, and is read several times:
    hand over a materialized table."""
    spark = docs.sparkSession
    bare, sizes = trial_weights(docs, part, trials, max_features, min_df)
    weights, rows = bare.weights, bare.rows
    training = assign_trials(docs, part, trials, "train")
    stored = feature_vectors(training, weights, ["y"], rows, max_features)
    most, cores = max(sizes.values(), default=0), spark.sparkContext.defaultParallelism
    # A task writes a file per model: as many rows in each as a fit's task works on, not those of one split of the documents.
    with small_batches(spark):
        matrix = materialize(stored.coalesce(max(_tasks(most), cores)), "matrix", ["model"], with_vectors(stored.schema))

    def fit(trial: Trial):
        # The objective of sum(log loss) * C + |w|^2 / 2, with a free intercept, in MLlib's scale.
        lr = LogisticRegression(
            labelCol="y", featuresCol="features", family="binomial", standardization=False, elasticNetParam=0.0,
            regParam=1.0 / (C * sizes[trial.model]), maxIter=max_iter, tol=tol,
        )
        rows = matrix.where(F.col("model") == trial.model)
        # Hundreds of short passes: few rows are best kept in few tasks.
        tasks = _tasks(sizes[trial.model])
        fitted = lr.fit(rows.coalesce(tasks) if tasks < rows.rdd.getNumPartitions() else rows)
        return trial.model, fitted.intercept, fitted.coefficients.toArray()

    with ThreadPoolExecutor(min(fits_at_once(most, cores), len(trials))) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(fit), trials))

    # Vocabulary-sized: max_features + 6 numbers per model.
    coefs = spark.createDataFrame(
        [(m, slot, float(c)) for m, _, cs in results for slot, c in enumerate(cs)], "model int, slot int, coef double"
    )
    intercepts = spark.createDataFrame([(m, float(b)) for m, b, _ in results], "model int, intercept double")
    fitted = weights.join(coefs, ["model", "slot"]).unionByName(intercept_rows(intercepts))
    return Model(materialize(fitted, "model"), rows)
