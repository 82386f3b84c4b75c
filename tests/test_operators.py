"""Dedup, ranks, splits, vocabulary and profiles on small tables and against brute force."""

import math
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from lexigauge.functions.signals import with_clean_text, with_signals
from lexigauge.operators import dedup, profile, rank, vocab

PLAN = lambda df: df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry the same text, and one group holds most rows."""
    rows = []
    for i in range(3000):
        text = "the very same text" if i % 3 == 0 else f"text {i % 900} of words"
        rows.append((i, text, "big" if i % 10 else "small", i % 7))
    return spark.createDataFrame(rows, "doc_id long, text string, grp string, ord int").repartition(8)


def test_keep_first_keeps_the_first_of_the_whole_corpus(skewed):
    kept = dedup.keep_first(skewed, ["ord", "doc_id"])
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: (r["ord"], r["doc_id"])):
        want.setdefault(r["text"], r["doc_id"])
    assert {r["text"]: r["doc_id"] for r in kept.collect()} == want
    # Copies are cut down to one per task before they are shuffled.
    assert "WindowGroupLimit" in PLAN(kept) and "Partial" in PLAN(kept)


def test_conflicting_labels_stop_the_run(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1)], "text string, y int")
    dedup.require_consistent_labels(df)
    bad = df.unionByName(spark.createDataFrame([("b", 0)], "text string, y int"))
    with pytest.raises(ValueError, match="both labels"):
        dedup.require_consistent_labels(bad)


def test_row_guard(skewed):
    dedup.require_rows(skewed, "grp", {"big": 2700, "small": 300})
    with pytest.raises(ValueError):
        dedup.require_rows(skewed, "grp", 1000)


def test_duplicate_audit_counts_nulls_as_identical_but_not_unique(spark):
    rows = [("g", "a b", 1), ("g", "a b", 1), ("g", "a  b", 1), ("g", "a b", 2), ("g", None, 1), ("g", None, 2)]
    df = spark.createDataFrame(rows, "grp string, raw_text string, other int")
    r = dedup.duplicate_audit(with_clean_text(df, "raw_text"), "grp", ["raw_text", "other"]).first()
    assert (r["n_rows"], r["identical_rows"], r["identical_text"], r["unique_text"], r["after_cleaning"]) == (6, 1, 3, 2, 2)


def test_shuffled_rank_is_the_plain_rank(skewed):
    key = rank.shuffle_key(F.concat("text", F.lit("-"), F.col("doc_id").cast("string")))
    ours = rank.with_shuffled_rank(skewed, "grp", key, digits=1)
    plain = skewed.withColumn("want", F.row_number().over(Window.partitionBy("grp").orderBy(key)))
    assert ours.join(plain.select("doc_id", "want"), "doc_id").where("rank <> want").count() == 0
    assert ours.count() == 3000


def test_folds_are_balanced_and_stable(skewed):
    keyed = skewed.withColumn("text_hash", F.sha2(F.col("doc_id").cast("string"), 256))
    folds = rank.stratified_folds(keyed, "grp")
    sizes = defaultdict(list)
    for r in folds.groupBy("grp", "fold").count().collect():
        sizes[r["grp"]].append(r["count"])
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in sizes.values())
    a = {r["doc_id"]: r["fold"] for r in folds.collect()}
    assert a == {r["doc_id"]: r["fold"] for r in rank.stratified_folds(keyed.repartition(3), "grp").collect()}
    loose = rank.stratified_folds(keyed, "grp", exact=False)
    assert "Exchange hashpartitioning" not in PLAN(loose) and loose.select("fold").distinct().count() == 5


def test_split_gives_every_group_its_share(spark):
    rows = [(i, f"h{i}", g) for i, g in enumerate("a" * 13 + "b" * 52 + "c" * 333 + "d" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text_hash string, grp string")
    split = rank.stratified_split(df, "grp")
    got = Counter((r["grp"], r["split"]) for r in split.collect())
    assert sum(n for (_, s), n in got.items() if s == "test") == math.ceil(0.2 * 401)
    for g, n in (("a", 13), ("b", 52), ("c", 333), ("d", 3)):
        assert abs(got[g, "test"] - 0.2 * n) < 1.01


def test_top_per_group_equals_plain_window(skewed):
    order = [F.desc("ord"), "doc_id"]
    ours = rank.top_per_group(skewed, ["grp"], order, 150, F.col("doc_id"), buckets=8)
    plain = skewed.withColumn("p", F.row_number().over(Window.partitionBy("grp").orderBy(*order))).where("p <= 150")
    assert {r["doc_id"] for r in ours.collect()} == {r["doc_id"] for r in plain.collect()}


def brute_vocabulary(texts, n):
    tf, df = Counter(), Counter()
    for t in texts:
        w = [x for x in t.split() if len(x) > 1]
        grams = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        tf.update(grams)
        df.update(set(grams))
    best = sorted((t for t in tf if df[t] >= 2), key=lambda t: (-tf[t], t))[:n]
    return {t: (i, tf[t], df[t]) for i, t in enumerate(sorted(best))}


def test_vocabulary_and_idf(spark):
    texts = [f"alpha beta{i % 4} gamma alpha{i % 3} gamma" for i in range(40)] + ["unique words here", "xy"]
    docs = vocab.with_term_counts(spark.createDataFrame([(t,) for t in texts], "low string"))
    words = vocab.with_idf(vocab.select_vocabulary(vocab.term_statistics(docs), 12), docs).collect()
    assert {r["term"]: (r["idx"], r["tf"], r["df"]) for r in words} == brute_vocabulary(texts, 12)
    assert all(r["idf"] == pytest.approx(math.log(43 / (1 + r["df"])) + 1) for r in words)


def test_part_statistics_add_up(spark):
    texts = [(f"alpha beta{i % 4} alpha gamma{i}", i % 3) for i in range(30)]
    docs = vocab.with_term_counts(spark.createDataFrame(texts, "low string, part int"))
    total = {r["term"]: (r["tf"], r["df"]) for r in vocab.term_statistics(docs).collect()}
    for r in vocab.part_statistics(docs, "part", [0, 1, 2]).collect():
        assert (r["tf_0"] + r["tf_1"] + r["tf_2"], r["df_0"] + r["df_1"] + r["df_2"]) == total[r["term"]]


def test_profile_median_and_rates(spark):
    lex = {"urgency": ("now",), "cta": ("here",)}
    texts = {"a": ["", "one", "do it now", "one two three four!"], "b": ["click here now", "see x.com", "A B"]}
    df = spark.createDataFrame([(g, t) for g, ts in texts.items() for t in ts], "grp string, raw string")
    docs = with_signals(with_clean_text(df), lex)
    rows = {r["grp"]: r for r in profile.group_profile(docs).collect()}
    for g, ts in texts.items():
        assert rows[g]["median_words"] == statistics.median(len(t.split(" ")) for t in ts)
    assert rows["a"]["urg_any"] == 25 and rows["b"]["cta_any"] == pytest.approx(100 / 3) and rows["b"]["urls"] == pytest.approx(1 / 3)
    rates = {(r["grp"], r["term"]): r["pct"] for r in profile.lexicon_rates(docs, ("now", "never")).collect()}
    assert rates["a", "never"] == 0 and rates["a", "now"] == rates["a", "any"] == 25


def test_top_words_ties_and_stop_words(spark):
    df = spark.createDataFrame([("g", "zeta alpha the"), ("g", "alpha zeta beta"), ("g", "www beta")], "grp string, low string")
    got = [(r["rank"], r["word"], r["docs"]) for r in profile.top_words(df, ("the", "www"), 2).orderBy("rank").collect()]
    assert got == [(1, "alpha", 2), (2, "beta", 2)]


def test_reference_values_weigh_groups_equally(spark):
    from lexigauge.plans.report import signal_reference

    rows = [("a", 1, 10, 80.0, 1.0, 50.0, 20.0, 3.0), ("b", 1, 9000, 100.0, 3.0, 30.0, 0.0, 5.0), ("c", 0, 5, 7.0, 0.5, 2.0, 1.0, 4.0)]
    table = spark.createDataFrame(rows, "grp string, y int, docs int, median_words double, urls double, urg_any double, cta_any double, caps double")
    got = signal_reference(profile.class_reference(table))
    assert got == {"urgency": (40, 2), "cta": (10, 1), "urls": (2, 0.5), "length": (90, 7), "caps": (4, 4)}


def test_marks_give_profile_rates_and_words(spark):
    """One pass over the documents gives what the three operators give on their own."""
    lex = {"urgency": ("now", "never"), "cta": ("here",)}
    rows = [("a", t) for t in ("Go now!", "now now here", "see x.com", "", "the word the word www")] + [("b", "never never Never"), ("b", None), (None, "now")]
    docs = with_clean_text(spark.createDataFrame(rows, "grp string, raw string").na.fill("", ["raw"]))
    ready = with_signals(docs, lex)
    marked = profile.marks(ready, lex["urgency"])
    same = lambda one, other: sorted(map(str, one.collect())) == sorted(map(str, other.select(one.columns).collect()))
    assert same(profile.group_profile(ready), profile.marked_profile(marked))
    known = "grp IS NOT NULL"  # joins by group leave rows without one aside
    assert same(profile.lexicon_rates(ready, lex["urgency"]), profile.marked_rates(marked, lex["urgency"]))
    assert same(profile.top_words(docs, ("the", "www"), 3).where(known), profile.marked_words(marked, ("the", "www"), 3))
    assert profile.marks(ready.where("false")).count() == 0


def test_first_signals_are_found_without_shuffling_texts(spark):
    from lexigauge.plans.corpus import distinct_documents, distinct_signals

    rows = [(i, f" Text  {i % 7} now! " if i % 3 else "the very same", "g", i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, raw string, grp string, grp_order int")
    lex = {"urgency": ("now",), "cta": ("here",)}
    narrow = distinct_signals(frame, lex)
    wide = with_signals(distinct_documents(frame), lex)
    columns = ["doc_id", "text_hash", "words", "caps", "urgency_hits", "punct_per_100w"]
    assert sorted(map(str, narrow.select(columns).collect())) == sorted(map(str, wide.select(columns).collect()))
    window = [line for line in PLAN(narrow).splitlines() if "Exchange" in line or "Window" in line]
    assert window and not {"text", "low", "raw"} & set(narrow.columns)
