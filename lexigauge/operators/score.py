"""Scores, explanations and per-document reports from a weight table with coefficients."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigauge.config import SIGNAL_LABELS, THRESHOLD
from lexigauge.functions.exprs import round_half_even, sigmoid
from lexigauge.operators import inrow
from lexigauge.operators.inrow import INTERCEPT, lookup_of
from lexigauge.operators.weights import ROW, norm_of, weighted_entries


def score(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(model, keys..., known_terms, z, p, pred): one row per row of `docs` and model, made in the document's row: no shuffle.

    `keys` are carried along; rows that repeat one are scored each for itself.
    """
    lookup = lookup_of(weights)
    return joined_score(docs, weights, keys, rows) if lookup is None else _judged(inrow.scores(docs, lookup, keys))


def joined_score(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The same for a weight table of any size, by a join of features. Shuffles one small row per document."""
    is_term, value, part = F.col("is_term"), F.col("value"), F.col("value") * F.col("coef")
    return (
        weighted_entries(docs, weights, keys, rows)
        .groupBy("model", ROW, *keys)
        .agg(
            F.sum(is_term.cast("long")).alias("known_terms"),
            norm_of(is_term, value).alias("_norm"),
            F.coalesce(F.sum(F.when(is_term, part)), F.lit(0.0)).alias("_terms"),
            F.sum(F.when(~is_term, part)).alias("_rest"),
        )
        .withColumn("z", F.col("_terms") / F.col("_norm") + F.col("_rest"))
        .drop(ROW, "_norm", "_terms", "_rest")
        .transform(_judged)
    )


def _judged(scored: DataFrame) -> DataFrame:
    return scored.withColumn("p", sigmoid(F.col("z"))).withColumn("pred", (F.col("p") >= THRESHOLD).cast("int"))


def explain(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(model, keys..., known_terms, z, p, pred, contributions): contributions by falling size, ties by name.

    The list has at most one entry per feature of the model, so it fits a row. It is made in the document's row.
    """
    lookup = lookup_of(weights)
    if lookup is None:
        return joined_explain(docs, weights, keys, rows)
    found = _judged(inrow.contributions(docs, lookup, keys))
    return found.select("model", *keys, "known_terms", "z", "p", "pred", "contributions")


def joined_explain(docs: DataFrame, weights: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The same for a weight table of any size, by a join of features."""
    is_term, value = F.col("is_term"), F.col("value")
    entry = F.struct(F.col("key").alias("term"), is_term.alias("is_term"), (value * F.col("coef")).alias("value"))
    per_doc = (
        weighted_entries(docs, weights, keys, rows)
        .groupBy("model", ROW, *keys)
        .agg(
            F.sum(is_term.cast("long")).alias("known_terms"),
            norm_of(is_term, value).alias("_norm"),
            F.collect_list(entry).alias("_entries"),
        )
    )
    scaled = F.transform(
        "_entries",
        lambda e: F.struct(
            e["term"].alias("term"),
            F.when(e["is_term"], e["value"] / F.col("_norm")).otherwise(e["value"]).alias("value"),
        ),
    )
    return (
        per_doc.withColumn("_all", scaled)
        .withColumn("z", F.aggregate("_all", F.lit(0.0), lambda a, e: a + e["value"]))
        .transform(_judged)
        .withColumn("contributions", _by_size(F.filter("_all", lambda e: e["term"] != INTERCEPT)))
        .drop(ROW, "_norm", "_entries", "_all")
    )


def _by_size(contributions: Column) -> Column:
    """Largest absolute value first, ties in term order, through the natural order of a struct."""
    keyed = F.transform(
        contributions, lambda e: F.struct((-F.abs(e["value"])).alias("k"), e["term"].alias("term"), e["value"].alias("value"))
    )
    return F.transform(F.sort_array(keyed), lambda e: F.struct(e["term"].alias("term"), e["value"].alias("value")))


def top_contributions(explained: DataFrame, keys: Sequence[str], n: int = 8) -> DataFrame:
    """(keys..., rank, term, value, rel_weight): the strongest contributions, scaled by the largest of them."""
    listed = explained.select(*keys, F.posexplode(F.slice("contributions", 1, n)).alias("pos", "_c"), "contributions")
    largest = F.greatest(F.abs(F.col("contributions")[0]["value"]), F.lit(1e-9))
    return listed.select(
        *keys,
        (F.col("pos") + 1).alias("rank"),
        F.col("_c.term").alias("term"),
        F.col("_c.value").alias("value"),
        (F.abs(F.col("_c.value")) / largest).alias("rel_weight"),
    )


def term_label(term: Column, labels: Mapping[str, str] = SIGNAL_LABELS) -> Column:
    """What a report calls a feature: the label of a signal, else the term in quotes."""
    label = F.coalesce(*[F.when(term == f"[{k}]", F.lit(v)) for k, v in labels.items()], F.lit(None).cast("string"))
    return F.when(term.startswith("["), F.coalesce(label, term)).otherwise(F.concat(F.lit("“"), term, F.lit("”")))


def document_report(
    explained: DataFrame, reference: Mapping[str, tuple[float, float]] | None = None, drivers: int = 8
) -> DataFrame:
    """One row per document: verdict, confidence, strongest drivers and six signals with a flag.

    `explained` is the output of `explain` with `words`, `chars`, `urls`, `urgency_hits`, `cta_hits`,
    `caps_pct` and `punct` among its keys. `reference` gives each signal's typical value for both classes.
    A blank text has no verdict; its score stays in `p`.
    """
    p, positive = F.col("p"), F.col("pred") == 1
    blank = F.col("words") == 0
    confidence = F.when(positive, p).otherwise(1 - p) * 100
    top = F.slice("contributions", 1, drivers)
    largest = F.greatest(F.coalesce(F.abs(F.get(F.col("contributions"), F.lit(0))["value"]), F.lit(0.0)), F.lit(1e-9))
    driver = lambda e: F.struct(
        term_label(e["term"]).alias("label"),
        e["value"].alias("value"),
        (F.abs(e["value"]) / largest).alias("rel_weight"),
        F.when(e["value"] > 0, "positive").otherwise("negative").alias("direction"),
    )
    first = lambda hits, n: F.when(F.size(hits) > 0, F.array_join(F.slice(hits, 1, n), ", ")).otherwise("none")

    def signal(name, shown, flag):
        typical = (reference or {}).get(name, (None, None))
        return F.struct(
            F.lit(name).alias("name"),
            shown.cast("string").alias("shown"),
            flag.alias("flagged"),
            *[F.lit(v).cast("double").alias(a) for v, a in zip(typical, ("typical_positive", "typical_negative"))],
        )

    signals = F.array(
        signal("urgency", first("urgency_hits", 3), F.size("urgency_hits") > 0),
        signal("cta", first("cta_hits", 2), F.size("cta_hits") > 0),
        signal("urls", F.col("urls"), (F.col("urls") > 0) & (F.col("urls") <= 3)),
        signal("length", F.concat_ws(" / ", F.col("words").cast("string"), F.col("chars").cast("string")), F.col("words") < 150),
        signal("caps", round_half_even(F.col("caps_pct"), 1), F.col("caps_pct") > 15),
        signal("punct", F.col("punct"), F.lit(False)),
    )
    return explained.select(
        "*",
        F.when(blank, "nothing_to_analyze").otherwise("scored").alias("status"),
        F.when(blank, None).when(positive, "positive").otherwise("negative").alias("verdict"),
        F.when(confidence >= 99, ">99").otherwise(F.floor(confidence + 0.5).cast("string")).alias("confidence"),
        round_half_even(100 * p, 1).alias("p_pct"),
        F.transform(top, driver).alias("drivers"),
        signals.alias("signals"),
    ).drop("contributions")


def strongest_terms(weights: DataFrame, n: int = 15, model: int = 0) -> DataFrame:
    """(side, rank, term, coef, rel_weight): the `n` largest and the `n` smallest term coefficients.

    Equal coefficients: the later term first on the positive side, the earlier on the negative side.
    """
    terms = weights.where(F.col("is_term") & (F.col("model") == model))
    sides = [
        terms.orderBy(F.desc("coef"), F.desc("slot")).limit(n).withColumn("side", F.lit("positive")),
        terms.orderBy("coef", "slot").limit(n).withColumn("side", F.lit("negative")),
    ]
    both = sides[0].unionByName(sides[1])
    order = F.when(F.col("side") == "positive", -F.col("coef")).otherwise(F.col("coef"))
    tie = F.when(F.col("side") == "positive", -F.col("slot")).otherwise(F.col("slot"))
    # 2n rows are left here.
    top = F.greatest(F.max(F.abs("coef")).over(Window.partitionBy(F.lit(0))), F.lit(1e-9))
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("side").orderBy(order, tie))).select(
        "side", "rank", F.col("key").alias("term"), "coef", (F.abs("coef") / top).alias("rel_weight")
    )
