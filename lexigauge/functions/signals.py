"""Per-document counts and the six numeric signals."""

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexigauge.config import LEXICONS, SIGNALS
from lexigauge.functions.clean import clean_text, lower_without_emails
from lexigauge.functions.lexicon import hits
from lexigauge.functions.urls import url_count


def word_count(text: Column) -> Column:
    """Blank-separated words of a cleaned text; an empty text has none."""
    return F.when(text == "", F.lit(0)).otherwise(split_length(text))


def split_length(text: Column) -> Column:
    """Length of the split at blanks, which is 1 for an empty text."""
    return count_char(text, " ") + 1


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def letter_count(text: Column) -> Column:
    """ASCII letters."""
    return F.length(text) - F.length(F.translate(text, string.ascii_letters, ""))


def with_clean_text(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add `text` (cleaned) and `low` (lower-cased, without email addresses)."""
    return df.withColumn("text", clean_text(F.col(raw))).withColumn("low", lower_without_emails(F.col("text")))


def with_signals(df: DataFrame, lexicons: Mapping[str, Sequence[str]] = LEXICONS) -> DataFrame:
    """Add counts, matched lexicon terms and the six signals to a table with `text` and `low`."""
    text, low = F.col("text"), F.col("low")
    counted = df.select(
        "*",
        word_count(text).alias("words"),
        split_length(text).alias("split_words"),
        F.length(text).alias("chars"),
        letter_count(text).alias("letters"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("caps"),
        count_char(text, "!").alias("excl"),
        count_char(text, "?").alias("quest"),
        url_count(low).alias("urls"),
        hits(low, lexicons["urgency"]).alias("urgency_hits"),
        hits(low, lexicons["cta"]).alias("cta_hits"),
    ).withColumn("punct", F.col("excl") + F.col("quest"))
    caps_ratio = F.when(F.col("letters") > 0, F.col("caps") / F.col("letters")).otherwise(F.lit(0.0))
    values = (
        F.log1p("words"),
        F.log1p("urls"),
        F.size("urgency_hits").cast("double"),
        F.size("cta_hits").cast("double"),
        caps_ratio,
        100.0 * F.col("punct") / F.greatest(F.col("words"), F.lit(1)),
    )
    return counted.select("*", *[v.alias(n) for n, v in zip(SIGNALS, values)]).withColumn(
        "caps_pct", 100.0 * F.col("caps_ratio")
    )
