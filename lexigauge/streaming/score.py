"""Scoring, and explaining, a stream of documents with a fixed model."""

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexigauge.config import LEXICONS
from lexigauge.functions.signals import with_clean_text
from lexigauge.functions.terms import tokens
from lexigauge.operators.score import document_report, explain, score
from lexigauge.plans.corpus import features
from lexigauge.plans.fit import Model
from lexigauge.sources.tables import spread

REPORT_COLUMNS = ("words", "chars", "urls", "urgency_hits", "cta_hits", "caps_pct", "punct")


def score_texts(
    docs: DataFrame, model: Model, lexicons: Mapping[str, Sequence[str]] = LEXICONS, raw: str = "raw", key: str = "doc_id",
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """(key, known_terms, z, p, pred), a row per row of raw texts; the batch form of the stream."""
    ready = features(with_clean_text(docs, raw), lexicons, words)
    return score(ready, model.weights, [key], model.rows).drop("model")


def report_texts(
    docs: DataFrame, model: Model, lexicons: Mapping[str, Sequence[str]] = LEXICONS, raw: str = "raw", key: str = "doc_id",
    reference: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """The report of every raw text: verdict, confidence, drivers and signals; the batch form of `report_stream`."""
    ready = features(with_clean_text(docs, raw), lexicons)
    return document_report(explain(ready, model.weights, [key, *REPORT_COLUMNS], model.rows), reference).drop("model")


def run_batches(docs: DataFrame, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Apply a batch plan to every micro-batch and write it to `<out>/run=<id>/batch=<number>`.

    There is no state across documents. A batch that is run again after a failure overwrites its own folder, so each document
    ends up there once. The id is the query's, which its checkpoint keeps: a query that starts anew without its checkpoint
    gets another id and overwrites nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        told = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()
        plan(spread(batch)).write.mode("overwrite").parquet(f"{out}/run={json.loads(told[0])['id']}/batch={number}")

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_stream(
    docs: DataFrame, model: Model, out: str, checkpoint: str, lexicons: Mapping[str, Sequence[str]] = LEXICONS, raw: str = "raw",
    key: str = "doc_id", **trigger,
) -> StreamingQuery:
    """Score every micro-batch."""
    return run_batches(docs, lambda batch: score_texts(batch, model, lexicons, raw, key), out, checkpoint, **trigger)


def report_stream(
    docs: DataFrame, model: Model, out: str, checkpoint: str, lexicons: Mapping[str, Sequence[str]] = LEXICONS, raw: str = "raw",
    key: str = "doc_id", reference: Mapping[str, tuple[float, float]] | None = None, **trigger,
) -> StreamingQuery:
    """Explain every document of every micro-batch."""
    return run_batches(docs, lambda batch: report_texts(batch, model, lexicons, raw, key, reference), out, checkpoint, **trigger)
