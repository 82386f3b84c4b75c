"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects a document whose signal is above a cutoff. For each stratum the labelled documents tell how many good
documents a cutoff would reject; an exact binomial test (the Clopper-Pearson bound) decides whether the share of good
documents lost is surely below the rule's share of `risk`. Cutoffs of a rule are tested from the most lenient one on and the
first that fails ends the sequence, so a rule counts as one test; the level is divided by rules and strata (Bonferroni).
Among the certified cutoffs the one with the least cost on the labelled documents is taken.

Defined cases: a null text is an empty one; a null stratum is a stratum of its own; without enough labelled documents
nothing is certified and a rule rejects nothing; several label rows of a document count as one with the largest label;
repeated rows are judged alike; an empty table gives an empty result; further columns are returned as they are, but for those
named like a statistic, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lexigauge.functions.exprs import small
from lexigauge.llm.batches import CONTINUATION, SPACE, add_columns
from lexigauge.sources.scratch import materialize

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
ID_BITS = 21

#: Rules and their cutoffs, the most lenient first.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_ratio": tuple(round(0.5 - 0.02 * i, 2) for i in range(25)),
    "dup_line_ratio": tuple(round(0.95 - 0.05 * i, 2) for i in range(18)),
    "repeat_ratio": tuple(round(0.5 - 0.02 * i, 2) for i in range(24)),
    "upper_ratio": tuple(round(0.95 - 0.05 * i, 2) for i in range(18)),
    "mean_word": tuple(40.0 - 2.0 * i for i in range(16)),
    "few_words": tuple(float(-50 - 5 * i) for i in range(11)),
}
_NONE = "\x00none"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    row = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    windows = np.column_stack([row[:-2], row[1:-1], row[2:]])
    if len(ids) < 1 << ID_BITS:
        key = (windows[:, 0] << 2 * ID_BITS) | (windows[:, 1] << ID_BITS) | windows[:, 2]
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    else:
        _, place, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(count[place.ravel()] > 1)
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[hit + shift] = True
    return int(inside.sum())


def _measure(data: bytes) -> tuple[int, ...]:
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(SPACE)]
    return (
        len(words),
        len(data.translate(None, SPACE + CONTINUATION)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, UPPER)),
    )


def text_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the counts in STATISTICS. Words are runs without ASCII white space; lines end at \\n and hold a word."""
    return add_columns(
        docs, text, [(name, T.LongType()) for name in STATISTICS],
        lambda texts: list(map(list, zip(*map(_measure, texts), strict=True))), keep,
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def signals() -> dict[str, Column]:
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / chars,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / words,
        "upper_ratio": F.col("n_upper") / chars,
        "mean_word": F.col("word_chars") / words,
        "few_words": -F.col("n_words").cast("double"),
    }


def _rejecting(value: Column, cutoffs: Sequence[float]) -> Column:
    return F.filter(F.array(*map(F.lit, cutoffs)), lambda cutoff: value > cutoff)


def stratum_of(columns: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit(_NONE)) for c in columns])


def tail(k: int, n: int, p: float) -> float:
    """Probability that a binomial variable of n trials is at most k: the exact p-value of "the rate is at least p"."""
    if k >= n * p:
        return 1.0  # never significant
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while term > total * 1e-17 and k >= 0:
        total += term
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return min(total, 1.0)


def choose(bad: np.ndarray, good: np.ndarray, n_good: int, rate: float, level: float, price: float) -> int | None:
    """Index of the cutoff taken from good and bad documents rejected by each cutoff (lenient first); None: none certified."""
    best, least = None, 0.0
    for i, (b, g) in enumerate(zip(bad, good, strict=True)):
        if tail(int(g), n_good, rate) > level:
            break
        cost = price * g - b
        if cost < least and b > 0:
            best, least = i, cost
    return best


def fit_cutoffs(
    stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", strata: Sequence[str] = ("lang",),
    risk: float = 0.03, confidence: float = 0.95, price: float = 100.0,
) -> DataFrame:
    """One row per stratum: `stratum` and a cutoff per rule (null where none is certified).

    `risk` bounds the share of good documents (label 1 that pass the base rules) that the rules of a stratum reject
    together, with `confidence` for all strata at once; `price` is what a lost good document costs against a kept bad one.
    Only histograms over the fixed cutoffs leave the scan; a task gets the histograms of a stratum.
    """
    truth = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.col(label).cast("int")).alias("_good")
    )
    steps = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.size(_rejecting(value, RULES[rule])).alias("step")) for rule, value in signals().items()
    ])
    narrow = stats.filter(~base_failed()).select(F.col(key).alias("_key"), stratum_of(strata).alias("stratum"), F.inline(steps))
    counts = narrow.join(truth, "_key").groupBy("stratum", "rule", "step").agg(
        F.sum(F.when(F.col("_good") > 0, 1).otherwise(0)).alias("good"), F.count(F.lit(1)).alias("rows")
    )
    counts = materialize(counts, "counts")
    n_strata = max(1, counts.select("stratum").distinct().count())
    level, rate = (1 - confidence) / (n_strata * len(RULES)), risk / len(RULES)
    schema = T.StructType([T.StructField("stratum", T.StringType())] + [T.StructField(f"cut_{r}", T.DoubleType()) for r in RULES])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        row: dict[str, object] = {"stratum": pdf["stratum"].iloc[0]}
        for rule, cutoffs in RULES.items():
            part = pdf[pdf["rule"] == rule]
            good = np.bincount(part["step"], weights=part["good"], minlength=len(cutoffs) + 1)
            rest = np.bincount(part["step"], weights=part["rows"] - part["good"], minlength=len(cutoffs) + 1)
            above = lambda h: h[::-1].cumsum()[:-1]  # noqa: E731  a document that k cutoffs reject is rejected by the k last ones
            at = choose(above(rest), above(good), int(good.sum()), rate, level, price)
            row[f"cut_{rule}"] = None if at is None else cutoffs[at]
        return pd.DataFrame([row], columns=[f.name for f in schema])

    return counts.groupBy("stratum").applyInPandas(one, schema)


def judge(stats: DataFrame, cutoffs: DataFrame, strata: Sequence[str] = ("lang",)) -> DataFrame:
    """Add `base_failed` and `kept`. The cutoffs of few strata are broadcast; many are joined by a shuffle."""
    table = materialize(cutoffs, "cutoffs").withColumnRenamed("stratum", "_stratum")
    joined = stats.withColumn("_stratum", stratum_of(strata)).join(small(table, table.count()), "_stratum", "left")
    above = [F.coalesce(value > F.col(f"cut_{rule}"), F.lit(False)) for rule, value in signals().items()]
    rejected = above[0]
    for x in above[1:]:
        rejected = rejected | x
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop(
        "_stratum", *[f"cut_{rule}" for rule in RULES]
    )


def apply_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", strata: Sequence[str] = ("lang",), keep: list[str] | None = None) -> DataFrame:
    """Statistics, certified cutoffs and verdict in one: `docs` (or its columns `keep`) with STATISTICS, base_failed and kept."""
    wanted = list(dict.fromkeys([*(docs.columns if keep is None else keep), key, *strata]))
    stats = materialize(text_statistics(docs, text, wanted), "statistics")
    return judge(stats, fit_cutoffs(stats, labels, key, strata=strata), strata)
