"""Steps whose time or memory must grow no faster than the input."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigauge.catalog.queries import write_lines
from lexigauge.config import SIGNALS
from lexigauge.functions.clean import decode_subject, nfkc
from lexigauge.functions.terms import run_lengths, term_counts, terms
from lexigauge.operators import inrow, score, vocab
from lexigauge.plans import fit
from lexigauge.plans.fit import Trial, fits_at_once
from lexigauge.sources.files import read_last_comma
from lexigauge.sources import scratch
from lexigauge.sources.scratch import materialize, small_batches


@pytest.fixture(scope="module")
def counted(spark, strings):
    rows = [(i, i % 3, t.lower()) for i, t in enumerate(strings)] + [(-1, 0, None), (-2, 1, ""), (-3, 2, "a"), (-4, 0, "ab ab")]
    docs = spark.createDataFrame(rows, "doc_id long, part int, low string")
    return materialize(vocab.with_term_counts(docs), "counted")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_counted_many_texts_at_once_as_in_the_row(spark, counted):
    assert "ArrowEvalPython" in plan(spark.createDataFrame([("ab",)], "low string").select(term_counts(F.col("low"))))
    want = counted.select("doc_id", run_lengths(terms(F.col("low"))).alias("counted"))
    got = counted.select("doc_id", "counted")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("buckets, tried", [(1 << 19, 3), (64, 1), (7, 1), (300, 2)])
def test_frequent_terms_are_those_of_the_full_count(counted, monkeypatch, buckets, tried):
    """Whether the buckets left out cannot matter, or do and are looked into."""
    monkeypatch.setattr(vocab, "BUCKETS", buckets)
    monkeypatch.setattr(vocab, "TRIED", tried)
    groups = [[0, 1], [2]]
    some = vocab.frequent_terms(counted, "part", [0, 1, 2], groups, 20)
    every = vocab.part_statistics(counted, "part", [0, 1, 2])
    for group in groups:
        top = lambda df: df.where(vocab._over([group], "df", 2)).orderBy(F.desc(vocab._summed("tf", group)), "term").limit(20).collect()
        assert top(some) == top(every)
    if buckets == 300:
        assert some.count() < every.count()


def test_scores_are_made_in_the_row(spark, counted):
    weights = spark.createDataFrame(
        [(0, "word", 6, True, 1.5, None, None, 0.7), (0, "dog", 7, True, 2.0, None, None, -0.4), (0, inrow.INTERCEPT, None, False, None, 0.0, 1.0, 0.1)]
        + [(0, f"[{n}]", i, False, None, 0.5, 2.0, 0.3) for i, n in enumerate(SIGNALS)],
        "model int, key string, slot int, is_term boolean, idf double, mean double, std double, coef double",
    )
    docs = counted.select("doc_id", "counted", *[(F.pmod("doc_id", F.lit(3 + i)) / 2).alias(n) for i, n in enumerate(SIGNALS)])
    own, joined = (f(docs, weights, ["doc_id"], 9) for f in (score.score, score.joined_score))
    assert "Exchange" not in plan(own)
    rounded = lambda df: df.select("model", "doc_id", "known_terms", F.round("z", 9), F.round("p", 9), "pred")
    assert own.columns == joined.columns and own.count() == joined.count()
    assert rounded(own).exceptAll(rounded(joined)).isEmpty()


@pytest.mark.parametrize("rows, cores, fits", [(1, 8, 8), (15_000, 6, 7), (80_000, 6, 2), (80_000, 12, 4), (240_001, 12, 1), (900_000, 12, 1), (9_000_000, 12, 1)])
def test_fits_side_by_side_fill_the_cores_and_no_more(rows, cores, fits):
    """The rows that fits keep in memory together: those of one fit, or twice a task's share of every core."""
    assert fits_at_once(rows, cores) == fits
    assert fits == 1 or fits * rows <= 2 * fit.ROWS_PER_TASK * cores


def test_large_fits_take_turns_and_write_few_files(spark, counted, monkeypatch):
    """Fits of more tasks than cores run one after the other, with the coefficients of fits side by side; files of the matrix follow rows, not splits."""
    signals = [(F.pmod("doc_id", F.lit(3 + i)) / 2).alias(n) for i, n in enumerate(SIGNALS)]
    docs = materialize(counted.repartition(60).select("doc_id", "part", F.when(F.col("low").contains("dog"), 1).otherwise(0).alias("y"), *signals, "counted"), "docs")
    trials = [Trial(i, f"without {i}", tuple(j for j in range(3) if j != i), (i,)) for i in range(3)]
    pools, written, batches, pool, write = [], {}, {}, fit.ThreadPoolExecutor, fit.materialize
    size = lambda: spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(fit, "ThreadPoolExecutor", lambda n: pools.append(n) or pool(n))
    monkeypatch.setattr(fit, "materialize", lambda df, name, *a: batches.update({name: size()}) or written.setdefault(name, write(df, name, *a)))

    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def coefficients():
        written.clear()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        try:
            model = fit.fit_trials(docs, "part", trials, 30, tol=1e-9)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", splits)
        files = [sum(f"model={t.model}/" in f for f in written["matrix"].inputFiles()) for t in trials]
        return {(r["model"], r["key"]): r["coef"] for r in model.weights.collect()}, files

    usual = size()
    together, files = coefficients()
    assert batches["matrix"] == str(scratch.BATCH_BYTES) and size() == usual
    assert max(files) <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(fit, "ROWS_PER_TASK", 100)
    alone, files = coefficients()
    assert max(files) <= -(-counted.count() // 100) and pools == [3, 1]
    assert alone.keys() == together.keys() and all(alone[k] == pytest.approx(together[k], abs=1e-4) for k in together)


def test_small_batches_reach_python_and_end(spark, counted, monkeypatch):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    one = counted.coalesce(1).select("counted")
    sizes = lambda: [(r["n"], r["bytes"]) for r in materialize(one.mapInArrow(run, "n long, bytes long"), "sizes").collect()]
    monkeypatch.setattr(scratch, "BATCH_BYTES", 50_000)
    whole = sizes()
    with small_batches(spark):
        parts = sizes()
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert len(parts) > 4 * len(whole) and max(b for _, b in parts) < 100_000
    assert sum(n for n, _ in parts) == sum(n for n, _ in whole) == counted.count() and len(sizes()) == len(whole)


def test_a_batch_is_looked_up_in_pieces(monkeypatch):
    monkeypatch.setattr(inrow, "AT_ONCE", 10)
    lists = [[{"term": "a", "cnt": 1.0}] * n for n in (4, 6, 1, 25, 0, 0, 9, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(lists), pa.array(range(len(lists)))], names=["counted", "doc_id"])
    pieces = list(inrow._pieces([batch, batch.slice(0, 0)]))
    assert all(sum(map(len, filter(None, p["counted"].to_pylist()))) <= 10 or p.num_rows == 1 for p in pieces)
    assert [d for p in pieces for d in p["doc_id"].to_pylist()] == list(range(len(lists)))


def test_batches_longer_than_a_piece_are_decoded_whole(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("\ufb01"), F.col("id").cast("string")).alias("t")).coalesce(1)
    subject = F.concat(F.lit("=?utf-8?q?=C3=A9?= "), F.col("id").cast("string"))
    wrong = rows.where((nfkc(F.col("t")) != F.concat(F.lit("fi"), F.col("id").cast("string"))) | ~decode_subject(subject).startswith("\u00e9"))
    assert wrong.isEmpty()


def test_lines_are_written_by_every_task_under_a_header(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_lines(spark.range(90).repartition(3).select(F.concat(F.lit("text "), F.col("id").cast("string"), F.lit(",1")).alias("value")), "text,label", path)
    files = [f for f in (tmp_path / "lines").glob("part-*") if f.stat().st_size]
    assert len(files) == 3 and all(f.read_text().startswith("text,label\n") for f in files)
    assert {r["raw"] for r in read_last_comma(spark, path).collect()} == {f"text {i}" for i in range(90)}
