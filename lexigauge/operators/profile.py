"""Group profiles: sizes, typical lengths, signal rates, frequent words."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigauge.config import LEXICONS
from lexigauge.functions.exprs import round_half_even
from lexigauge.functions.terms import alpha_words

# Metrics of a profile and the digits they are published with.
PROFILE_METRICS = {
    "median_words": None, "urls": 2, "url_any": 1, "urg_any": 1, "cta_any": 1, "caps": 1, "excl": 2,
}
COMPARED = ("urg_any", "cta_any", "url_any", "caps", "excl")
REFERENCED = ("median_words", "urls", "urg_any", "cta_any", "caps")


def _histogram(signals: DataFrame, group: str) -> DataFrame:
    """Sums per (group, length). Small: one row per distinct length, whatever the number of documents."""
    return signals.groupBy(group, "split_words").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("urls").alias("urls"),
        F.sum((F.col("urls") > 0).cast("long")).alias("url_any"),
        F.sum((F.size("urgency_hits") > 0).cast("long")).alias("urg_any"),
        F.sum((F.size("cta_hits") > 0).cast("long")).alias("cta_any"),
        F.sum("caps_ratio").alias("caps"),
        F.sum("excl").alias("excl"),
    )


def group_profile(signals: DataFrame, group: str = "grp") -> DataFrame:
    """One row per group: documents, median length, mean URLs, rates (in %) and mean `!`; not rounded.

    The exact median comes from the histogram of lengths, so the documents are shuffled once, as
    partial sums, and no task sees a whole group.
    """
    return _profile_of(_histogram(signals, group), group)


def _profile_of(hist: DataFrame, group: str) -> DataFrame:
    upto = F.sum("n").over(Window.partitionBy(group).orderBy("split_words"))
    total = F.sum("n").over(Window.partitionBy(group))
    placed = hist.withColumn("_upto", upto).withColumn("_total", total)

    def at(position: Column) -> Column:
        inside = (F.col("_upto") > position) & (F.col("_upto") - F.col("n") <= position)
        return F.max(F.when(inside, F.col("split_words")))

    lower = F.floor((F.col("_total") - 1) / 2)
    upper = F.floor(F.col("_total") / 2)
    docs = F.sum("n")
    return placed.groupBy(group).agg(
        docs.alias("docs"),
        ((at(lower) + at(upper)) / 2).alias("median_words"),
        (F.sum("urls") / docs).alias("urls"),
        *[(100 * F.sum(m) / docs).alias(m) for m in ("url_any", "urg_any", "cta_any", "caps")],
        (F.sum("excl") / docs).alias("excl"),
    )


def published(profile: DataFrame) -> DataFrame:
    """A profile with the digits it is published with."""
    return profile.select(
        *[
            round_half_even(F.col(c), PROFILE_METRICS[c]).alias(c) if PROFILE_METRICS.get(c) else F.col(c)
            for c in profile.columns
        ]
    )


def lexicon_rates(
    signals: DataFrame, terms: Sequence[str] = LEXICONS["urgency"], hits: str = "urgency_hits", group: str = "grp"
) -> DataFrame:
    """(group, term, pct): share of documents with each term and with 'any'; terms never seen have 0.

    One wide aggregate, unpivoted afterwards: the grid is complete without joining documents to terms.
    """
    shares = [F.avg((F.size(hits) > 0).cast("double")).alias("s_any")] + [
        F.avg(F.array_contains(hits, t).cast("double")).alias(f"s_{i}") for i, t in enumerate(terms)
    ]
    cells = [F.struct(F.lit("any").alias("term"), (100 * F.col("s_any")).alias("pct"))] + [
        F.struct(F.lit(t).alias("term"), (100 * F.col(f"s_{i}")).alias("pct")) for i, t in enumerate(terms)
    ]
    return signals.groupBy(group).agg(*shares).select(group, F.inline(F.array(*cells)))


def top_words(docs: DataFrame, stop_words: Sequence[str], n: int = 10, group: str = "grp") -> DataFrame:
    """(group, rank, word, docs, pct): the words in most documents of a group; ties in word order."""
    words = docs.select(group, F.explode_outer(alpha_words(F.col("low"))).alias("word"))
    counts = (
        words.where(~F.col("word").isin(list(stop_words)))
        .groupBy(group, "word")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    return _top_words(counts, docs.groupBy(group).agg(F.count(F.lit(1)).alias("_n")), n, group)


def _top_words(counts: DataFrame, sizes: DataFrame, n: int, group: str) -> DataFrame:
    best = Window.partitionBy(group).orderBy(F.desc("docs"), "word")
    return (
        counts.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .join(sizes, group)
        .select(group, "rank", "word", "docs", (100 * F.col("docs") / F.col("_n")).alias("pct"))
    )


def marks(signals: DataFrame, terms: Sequence[str] = LEXICONS["urgency"], hits: str = "urgency_hits", group: str = "grp") -> DataFrame:
    """(group, kind, key, n, sums...): all that profile, lexicon rates and top words need, from one pass over the documents.

    A document gives a row of kind 'length' with its sums, a row 'term' for every lexicon term in it (and 'any'), and a row 'word'
    for every word, which are added up by kind and key before and behind one shuffle.
    """
    row = lambda kind, key, one=False: F.struct(
        F.lit(kind).alias("kind"), key.alias("key"),
        *[(F.col(c) if one else F.lit(None)).cast("double").alias(c) for c in ("urls", "caps_ratio", "excl")],
        *[(F.size(c) > 0 if one else F.lit(None)).cast("long").alias(f"{c}_any") for c in ("urgency_hits", "cta_hits")],
    )
    found = F.filter(hits, lambda t: t.isin(list(terms)))
    every = F.concat(
        F.array(row("length", F.col("split_words").cast("string"), True)),
        F.transform(F.when(F.size(hits) > 0, F.concat(F.array(F.lit("any")), found)).otherwise(found), lambda t: row("term", t)),
        F.transform(alpha_words(F.col("low")), lambda w: row("word", w)),
    )
    long = signals.select(group, F.inline_outer(every))
    return long.groupBy(group, "kind", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("urls").cast("long").alias("urls"), F.sum((F.col("urls") > 0).cast("long")).alias("url_any"),
        F.sum("urgency_hits_any").alias("urg_any"), F.sum("cta_hits_any").alias("cta_any"), F.sum("caps_ratio").alias("caps"),
        F.sum("excl").cast("long").alias("excl"),
    )


def marked_profile(marked: DataFrame, group: str = "grp") -> DataFrame:
    """`group_profile` from marks."""
    hist = marked.where("kind = 'length'").withColumn("split_words", F.col("key").cast("int")).drop("kind", "key")
    return _profile_of(hist, group)


def _sizes(marked: DataFrame, group: str) -> DataFrame:
    return marked.where("kind = 'length'").groupBy(group).agg(F.sum("n").alias("_n"))


def marked_rates(marked: DataFrame, terms: Sequence[str] = LEXICONS["urgency"], group: str = "grp") -> DataFrame:
    """`lexicon_rates` from marks; the grid of groups and terms is complete."""
    grid = _sizes(marked, group).select(group, "_n", F.explode(F.array(*[F.lit(t) for t in ("any", *terms)])).alias("term"))
    seen = marked.where("kind = 'term'").select(F.col(group).alias("_group"), F.col("key").alias("_term"), "n")
    matched = grid.join(seen, F.col(group).eqNullSafe(F.col("_group")) & (F.col("term") == F.col("_term")), "left")
    return matched.select(group, "term", (100 * (F.coalesce("n", F.lit(0)) / F.col("_n"))).alias("pct"))


def marked_words(marked: DataFrame, stop_words: Sequence[str], n: int = 10, group: str = "grp") -> DataFrame:
    """`top_words` from marks."""
    counts = marked.where((F.col("kind") == "word") & ~F.col("key").isin(list(stop_words))).select(group, F.col("key").alias("word"), F.col("n").alias("docs"))
    return _top_words(counts, _sizes(marked, group), n, group)


def rollup_counts(docs: DataFrame, origin: str = "origin", label: str = "y", text: str = "text_hash") -> DataFrame:
    """Rows and distinct texts for all, per label, per origin and per both, in one pass.

    A text counts in every cell it occurs in. A total has the key 'all'; `level` is 0 for a cell of both keys.
    """
    sets = [[F.col(origin), F.col(label)], [F.col(origin)], [F.col(label)], []]
    cells = docs.groupingSets(sets, origin, label).agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(text).alias("distinct_texts"),
    )
    named = lambda key, bit: F.when(F.col("level").bitwiseAND(bit) > 0, "all").otherwise(F.col(key).cast("string")).alias(key)
    return cells.select(named(origin, 2), named(label, 1), "level", "n_rows", "distinct_texts")


def class_reference(profile: DataFrame, label: str = "y", metrics: Sequence[str] = REFERENCED) -> DataFrame:
    """Mean over the groups of a class, each group with equal weight."""
    return profile.groupBy(label).agg(*[F.avg(m).alias(m) for m in metrics])


def comparison(
    profile: DataFrame, group: str = "grp", shown: Sequence[str] | None = None, metrics: Sequence[str] = COMPARED
) -> DataFrame:
    """(metric, group, value, rel_weight): chosen metrics side by side, each scaled by its largest value * 1.1.

    `shown` restricts the groups; scaling uses the shown groups only. Works on the group table, so it is small.
    """
    rows = profile if shown is None else profile.where(F.col(group).isin(list(shown)))
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long = rows.select(group, F.inline(cells))
    top = F.max("value").over(Window.partitionBy("metric")) * 1.1
    return long.withColumn("_top", top).select(
        "metric", group, "value", F.when(F.col("_top") > 0, F.col("value") / F.col("_top")).otherwise(F.lit(0.0)).alias("rel_weight")
    )


def stats_table(
    profile: DataFrame, rates: DataFrame, words: DataFrame, counts: DataFrame, group: str = "grp"
) -> DataFrame:
    """All published numbers as one long table (metric, key, group, value).

    `counts` has (group, n_rows, distinct_texts). Words carry their rank in front, as in '01 word'.
    """
    shown = published(profile)
    metrics = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).cast("double").alias("value"))
        for m in PROFILE_METRICS
    ])
    totals = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value"))
        for m, c in (("rows", "n_rows"), ("distinct", "distinct_texts"))
    ])
    columns = ["metric", "key", group, "value"]
    return (
        shown.select(group, F.inline(metrics)).select(*columns)
        .unionByName(counts.select(group, F.inline(totals)).select(*columns))
        .unionByName(
            rates.select(
                F.lit("urgency").alias("metric"), F.col("term").alias("key"), group, round_half_even(F.col("pct"), 1).alias("value")
            )
        )
        .unionByName(
            words.select(
                F.lit("words").alias("metric"),
                F.concat(F.lpad(F.col("rank").cast("string"), 2, "0"), F.lit(" "), F.col("word")).alias("key"),
                group,
                round_half_even(F.col("pct"), 0).alias("value"),
            )
        )
    )
