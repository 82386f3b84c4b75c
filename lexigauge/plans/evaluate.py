"""Quality reports: cross-validation, hold-out, and transfer between origins."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from lexigauge.config import FOLDS, INVERSE_REGULARISATION, SEED, SIGNALS, TEST_SHARE
from lexigauge.functions.exprs import percent
from lexigauge.operators.rank import stratified_folds, stratified_split
from lexigauge.operators import inrow
from lexigauge.operators.score import score
from lexigauge.plans.fit import Model, Trial, assign_trials, fit_trials
from lexigauge.sources.scratch import materialize, small_batches


def fold_trials(folds: int = FOLDS) -> list[Trial]:
    return [Trial(i, f"fold {i}", tuple(j for j in range(folds) if j != i), (i,)) for i in range(folds)]


def origin_trials(pairs: Sequence[tuple[str, str]]) -> list[Trial]:
    """One trial per (origin to fit on, origin to test on)."""
    return [Trial(i, f"{a}_to_{b}", (a,), (b,)) for i, (a, b) in enumerate(pairs)]


HOLDOUT = (Trial(0, "holdout", ("train",), ("test",)),)


def predictions(docs: DataFrame, part: str, trials: Sequence[Trial], model: Model, key: str = "doc_id") -> DataFrame:
    """(model, key, grp, y, p, pred, ...) for the test documents of every trial."""
    tested = assign_trials(docs, part, trials, "test")
    return score(tested, model.weights, [key, "grp", "y"], model.rows)


def outcome_counts(predicted: DataFrame) -> DataFrame:
    """(model, grp, y, n, correct, positive): all quality figures derive from this small table."""
    return predicted.groupBy("model", "grp", "y").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("pred") == F.col("y")).cast("long")).alias("correct"),
        F.sum(F.col("pred").cast("long")).alias("positive"),
    )


def accuracy(outcomes: DataFrame, *by: str) -> DataFrame:
    return outcomes.groupBy(*by).agg((F.sum("correct") / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))


def fold_summary(outcomes: DataFrame) -> DataFrame:
    """(scope, grp, mean_pct, sd_pct): mean and population deviation of the fold accuracies.

    A group without documents in a fold contributes nothing for that fold.
    """
    per_group = accuracy(outcomes, "model", "grp").select(F.lit("group").alias("scope"), "grp", "accuracy")
    overall = accuracy(outcomes, "model").select(F.lit("overall").alias("scope"), F.lit(None).cast("string").alias("grp"), "accuracy")
    return (
        overall.unionByName(per_group)
        .groupBy("scope", "grp")
        .agg(percent(F.avg("accuracy")).alias("mean_pct"), percent(F.stddev_pop("accuracy")).alias("sd_pct"))
    )


def holdout_summary(outcomes: DataFrame) -> DataFrame:
    """(scope, grp, accuracy_pct, n)."""
    per_group = accuracy(outcomes, "grp").select(F.lit("group").alias("scope"), "grp", "accuracy", "n")
    overall = accuracy(outcomes).select(F.lit("overall").alias("scope"), F.lit(None).cast("string").alias("grp"), "accuracy", "n")
    return overall.unionByName(per_group).select("scope", "grp", percent(F.col("accuracy")).alias("accuracy_pct"), "n")


def transfer_summary(outcomes: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    """One row per direction: accuracy, balanced accuracy, recall of both classes, predicted positives, all in %."""
    positives, negatives = F.col("y") == 1, F.col("y") == 0
    total = lambda c, cond=None: F.sum(F.col(c) if cond is None else F.when(cond, F.col(c)))
    found = total("positive", positives) / total("n", positives)
    spared = 1 - total("positive", negatives) / total("n", negatives)
    names = F.array(*[F.lit(t.name) for t in sorted(trials, key=lambda t: t.model)])
    shares = outcomes.groupBy("model").agg(
        (total("correct") / total("n")).alias("accuracy"),
        ((found + spared) / 2).alias("balanced_accuracy"),
        found.alias("positive_recall"),
        spared.alias("negative_recall"),
        (total("positive") / total("n")).alias("predicted_positive"),
    )
    return shares.select(
        F.get(names, F.col("model")).alias("direction"),
        *[percent(F.col(c)).alias(f"{c}_pct") for c in shares.columns if c != "model"],
        percent(1 - F.col("negative_recall")).alias("false_flag_pct"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    """`df`, which counts or looks up terms in Python, written."""
    with small_batches(df.sparkSession):
        return materialize(df, name)


def slim(features: DataFrame, *extra: str) -> DataFrame:
    """What fitting and scoring need of a feature table."""
    return features.select("doc_id", "grp", "y", *extra, *SIGNALS, "counted")


def with_part(features: DataFrame, part: str, assign: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The slim features with the column `part` that `assign` adds to a table with `grp` and `text_hash`.

    The features are made and written once; ranking reads and shuffles two short columns of that. A text occurs once.
    """
    slimmed = _written(slim(features, "text_hash"), "features")
    parts = assign(slimmed.select("grp", "text_hash")).select("text_hash", part)
    return materialize(slimmed.join(parts, "text_hash").drop("text_hash"), part)


def cross_validate(
    features: DataFrame, folds: int = FOLDS, seed: int = SEED, fitter: Callable[..., Model] = fit_trials, **fit
) -> DataFrame:
    """Fold accuracies of models fitted on the other folds; see `fold_summary`. `fitter` makes the models, see `fixed_trials`."""
    docs = with_part(features, "fold", lambda df: stratified_folds(df, "grp", folds, seed))
    trials = fold_trials(folds)
    model = fitter(docs, "fold", trials, **fit)
    return fold_summary(_written(outcome_counts(predictions(docs, "fold", trials, model)), "outcomes"))


def split_features(features: DataFrame, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """The slim features with `split`, written."""
    return with_part(features, "split", lambda df: stratified_split(df, "grp", share, seed))


def hold_out(
    features: DataFrame, share: float = TEST_SHARE, seed: int = SEED, fitter: Callable[..., Model] = fit_trials, **fit
) -> tuple[Model, DataFrame, DataFrame]:
    """The exported model, its test predictions and their summary."""
    docs = split_features(features, share, seed)
    model = fitter(docs, "split", HOLDOUT, **fit)
    predicted = _written(predictions(docs, "split", HOLDOUT, model), "predicted")
    return model, predicted, holdout_summary(outcome_counts(predicted))


def certificate(docs: DataFrame, part: str, trials: Sequence[Trial], model: Model, C: float = INVERSE_REGULARISATION) -> DataFrame:
    """(model, n_train, n_terms, loss, gradient, intercept_gradient): how far every trial's coefficients can be from the optimum.

    The objective |w|^2 / 2 + C * sum(log loss) curves by at least 1 in every coefficient, so with the intercept at its best they
    are off by `gradient`, the length of the gradient at the coefficients, at most. It is computed from the training documents and
    the weight table, not from what the optimiser reported: one scan, then one row per coefficient.
    """
    lookup = inrow.lookup_of(model.weights, max(model.rows, 1))
    slopes = inrow.slopes(assign_trials(docs, part, trials, "train"), lookup, "y")
    summed = slopes.groupBy("model", "key").agg(F.sum("slope").alias("slope"), F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    table = model.weights.select("model", "key", "is_term", "coef").join(summed, ["model", "key"], "left").na.fill(0.0, ["slope"])
    constant = F.col("key") == inrow.INTERCEPT
    own = F.when(~constant, F.col("coef") - C * F.col("slope"))
    return table.groupBy("model").agg(
        F.max(F.when(constant, F.col("n"))).alias("n_train"), F.count_if("is_term").alias("n_terms"),
        (F.sum(F.when(~constant, F.col("coef") * F.col("coef"))) / 2 + C * F.max(F.when(constant, F.col("loss")))).alias("loss"),
        F.sqrt(F.sum(own * own)).alias("gradient"), F.abs(C * F.max(F.when(constant, F.col("slope")))).alias("intercept_gradient"),
    )


def cross_origin(
    features: DataFrame, pairs: Sequence[tuple[str, str]], fitter: Callable[..., Model] = fit_trials, **fit
) -> DataFrame:
    """Fit on one origin, test on another, for the pairs given; see `transfer_summary`."""
    docs = _written(slim(features, "origin"), "origins")
    trials = origin_trials(pairs)
    model = fitter(docs, "origin", trials, **fit)
    return transfer_summary(_written(outcome_counts(predictions(docs, "origin", trials, model)), "outcomes"), trials)
