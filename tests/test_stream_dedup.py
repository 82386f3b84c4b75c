"""Streams of texts without repeats: within and beyond the watermark, over restarts, and against the batch rule."""

import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigauge.streaming import dedup

SCHEMA = "id long, at timestamp, raw string, extra string"


class Feed:
    """A folder of files that a stream reads one by one in the order they were written."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0
        os.makedirs(self.folder)

    def add(self, rows):
        """`rows`: (id, minute, text)."""
        frame = self.spark.createDataFrame([(i, m, t, "x") for i, m, t in rows], "id long, m long, raw string, extra string")
        staged = f"{self.folder}-{self.n}"
        frame.select("id", F.timestamp_seconds(1_700_000_000 + 60 * F.col("m")).alias("at"), "raw", "extra").coalesce(1).write.parquet(staged)
        (part,) = [f for f in os.listdir(staged) if f.endswith(".parquet")]
        target = f"{self.folder}/{self.n:03d}.parquet"
        os.rename(f"{staged}/{part}", target)
        os.utime(target, (time.time() + self.n, time.time() + self.n))
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.folder)

    def batch(self):
        return self.spark.read.schema(SCHEMA).parquet(self.folder)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def run(rows, tmp_path):
    dedup.write_stream(rows, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()


def written(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "out"))


def test_repeats_within_and_beyond_the_watermark(spark, feed, tmp_path):
    feed.add([(1, 0, "one"), (2, 1, "two"), (3, 1, " One"), (4, 2, "two  ")])  # two is repeated in its own file, but for white space
    feed.add([(5, 5, "two"), (6, 6, "three"), (7, 0, "one")])
    run(dedup.drop_repeats(feed.stream(), "at", "10 minutes"), tmp_path)
    assert Counter(r["raw"].strip() for r in written(spark, tmp_path).collect()) == {"one": 1, "two": 1, "One": 1, "three": 1}
    # The query is started again with the same checkpoint. Minute 30 moves the watermark beyond all that was seen.
    feed.add([(8, 8, "one"), (9, 30, "four")])
    feed.add([(13, 31, "five")])  # its batch clears the state of all that expired before minute 20
    feed.add([(10, 32, "one"), (11, 32, "four"), (12, 12, "late")])
    run(dedup.drop_repeats(feed.stream(), "at", "10 minutes"), tmp_path)
    rows = {r["id"]: r["raw"].strip() for r in written(spark, tmp_path).collect()}
    assert {8, 11, 12}.isdisjoint(rows) and {9, 10} <= set(rows)  # within the delay; beyond it; late
    assert Counter(rows.values()) == {"one": 2, "two": 1, "One": 1, "three": 1, "four": 1, "five": 1}


def test_odd_rows(spark, feed, tmp_path):
    feed.add([(1, 0, None), (2, 0, ""), (3, 0, " \t"), (4, None, "untimed"), (5, 0, "x" * 500_000), (6, 1, "x" * 500_000), (6, 1, "twin"), (6, 1, "twin")])
    for frame in (feed.batch(), None):
        if frame is None:
            run(dedup.drop_repeats(feed.stream(), "at", "1 day"), tmp_path)
            kept = written(spark, tmp_path)
        else:
            kept = dedup.drop_repeats(frame, "at", "1 day")
        assert kept.columns == ["id", "at", "raw", "extra", "text_hash"]
        assert kept.count() == 3 and kept.select("text_hash").distinct().count() == 3
    empty = dedup.first_per_window(feed.batch().filter("false"), "at", "1 hour", "1 minute", ["id"])
    assert empty.count() == 0


def _closed(frame, seconds):
    return {(r["window"]["start"], r["text_hash"], r["id"], r["copies"]) for r in frame.collect() if r["window"]["end"].timestamp() <= seconds}


@pytest.mark.parametrize("files", [1, 4, 9])
def test_first_per_window_equals_the_batch_however_it_is_cut(spark, feed, tmp_path, files):
    rng = random.Random(files)
    rows = sorted((rng.randint(0, 600) + rng.random() / 2, i, rng.choice(["a", "b", "B b", "c"]) * rng.randint(1, 3)) for i in range(300))
    rows = [(i, int(m), t) for m, i, t in rows]
    near = [rows[j : j + 20] for j in range(0, 300, 20)]
    rows = [r for part in near for r in sorted(part, key=lambda _: rng.random())]  # out of order, but by less than the delay
    step = -(-300 // files)
    for j in range(0, 300, step):
        feed.add(rows[j : j + step])
    plan = lambda frame: dedup.first_per_window(frame, "at", "1 hour", "2 hours", ["id"], ["extra"])
    run(plan(feed.stream()), tmp_path)
    got = written(spark, tmp_path)
    assert got.columns == ["window", "text_hash", "at", "id", "extra", "copies"]
    closed = feed.batch().agg(F.max("at")).first()[0].timestamp() - 7200
    want = _closed(plan(feed.batch()), closed)
    assert len(want) > 20 and _closed(got, float("inf")) == want


def test_state_is_cleared(spark, feed, tmp_path):
    for i in range(6):
        feed.add([(100 * i + j, 100 * i, f"text {100 * i + j}") for j in range(50)])
    query = dedup.write_stream(
        dedup.drop_repeats(feed.stream(), "at", "10 minutes").select("id", "text_hash"), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    query.awaitTermination()
    held = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert written(spark, tmp_path).count() == 300 and max(held) <= 100


def test_utc_time_ignores_the_session_zone(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00.123456' AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert frame.select(F.unix_micros(dedup.utc_time(F.col("t")))).first()[0] == 1711852200123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
