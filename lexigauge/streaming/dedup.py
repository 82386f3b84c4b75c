"""Exact deduplication of a stream of texts: repeats of a cleaned text are dropped as they come, or per window of event time.

Both keep their state by the hash of the cleaned text and let the watermark clear it, so the state grows with the distinct texts of
the time span, not with the stream. Both are plans over a table with an event time and give their batch result for a batch table.

* `drop_repeats` passes a text on at once and drops its repeats for `delay` of event time after it. Which of several equal rows of
  one micro-batch is kept is open; a repeat that comes later than `delay` may be kept, and is once the watermark has passed.
* `first_per_window` keeps the first row, by event time and `order`, of every text in every window. The result does not depend on
  how the stream was cut into micro-batches. A window's rows come when the watermark has passed its end.

Rows that arrive more than `delay` behind the latest event of earlier micro-batches are late: `first_per_window` drops them where their
window is closed, and `drop_repeats` drops them too, as the state that would tell whether they repeat a text is gone.

Defined cases: null texts count as empty ones; rows without an event time are in no window and are kept by
neither; equal rows are repeats of each other; further columns are passed on.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lexigauge.functions.clean import clean_text
from lexigauge.operators.dedup import text_hash


def utc_time(local: Column) -> Column:
    """A timestamp without time zone as one of the UTC time line, whatever the session's zone: event times need the zoned type."""
    return F.concat(local.cast("string"), F.lit("Z")).cast("timestamp")


def with_text_hash(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Add `text_hash` of the cleaned text."""
    return rows.withColumn("text_hash", text_hash(clean_text(F.coalesce(F.col(raw), F.lit("")))))


def drop_repeats(rows: DataFrame, time: str, delay: str, raw: str = "raw") -> DataFrame:
    """`rows` with `text_hash`, without those that repeat a text seen within `delay`.

    On a batch, where there is no watermark, one row of every text is kept.
    """
    timed = with_text_hash(rows, raw).filter(F.col(time).isNotNull())
    if not rows.isStreaming:
        return timed.dropDuplicates(["text_hash"])
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_hash"])


def first_per_window(
    rows: DataFrame, time: str, window: str, delay: str, order: Sequence[str], carried: Sequence[str] = (), raw: str = "raw"
) -> DataFrame:
    """(window, text_hash, time, order..., carried..., copies): the first row of every text in every window, and its copies there.

    The state holds one row per window and text, with the columns `order` and `carried` only; texts need not be among them.
    """
    first = [c for c in dict.fromkeys([time, *order, *carried])]
    timed = with_text_hash(rows, raw).filter(F.col(time).isNotNull())
    kept = (
        timed.withWatermark(time, delay)
        .groupBy(F.window(time, window).alias("window"), "text_hash")
        .agg(F.min(F.struct(*first)).alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    return kept.select("window", "text_hash", *[F.col("first")[c].alias(c) for c in first], "copies")


def write_stream(rows: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a deduplicated stream to Parquet files in `out`.

    State and progress are in `checkpoint`, a folder the cluster shares: a query that starts again there drops the repeats of what
    earlier runs passed on, and writes no row twice.
    """
    return (
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
