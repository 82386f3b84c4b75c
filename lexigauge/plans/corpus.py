"""From a loaded corpus to distinct documents and their features."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexigauge.config import LEXICONS
from lexigauge.functions.clean import clean_text, lower_without_emails
from lexigauge.functions.signals import with_clean_text, with_signals
from lexigauge.functions.terms import tokens
from lexigauge.operators.dedup import keep_first, text_hash
from lexigauge.operators.vocab import with_term_counts


def distinct_documents(corpus: DataFrame, order: Sequence[str] = ("grp_order", "doc_id"), keep_raw: bool = False) -> DataFrame:
    """Clean every text and keep the first of equal ones; adds `text`, `text_hash`, `low`."""
    cleaned = corpus.withColumn("text", clean_text(F.col("raw")))
    kept = keep_first(cleaned if keep_raw else cleaned.drop("raw"), order)
    # Derived after the shuffle rather than carried through it.
    return kept.withColumn("low", lower_without_emails(F.col("text")))


def distinct_signals(
    corpus: DataFrame, lexicons: Mapping[str, Sequence[str]] = LEXICONS, order: Sequence[str] = ("grp_order", "doc_id")
) -> DataFrame:
    """Counts and signals of the first of equal texts, without the texts.

    All is made in the scan, so what is shuffled to find the first of a text is its hash, the order and some numbers.
    """
    ready = with_signals(with_clean_text(corpus), lexicons)
    return keep_first(ready.withColumn("text_hash", text_hash(F.col("text"))).drop("raw", "text", "low"), order, text=None)


def features(
    documents: DataFrame, lexicons: Mapping[str, Sequence[str]] = LEXICONS, words: Callable[[Column], Column] = tokens
) -> DataFrame:
    """Signals and in-document term counts: all a fit or a score needs. `words` is the caller's own way to cut a text into words."""
    return with_term_counts(with_signals(documents, lexicons), words)
