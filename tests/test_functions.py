"""Column functions against plain Python on random texts."""

import itertools
import random
import re
import sys
import time
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigauge import config
from lexigauge.functions import clean, exprs, lexicon, signals, terms, urls

BLANKS = re.compile(r"[\s﻿]+")
# fixed value: what counts as a URL
HOST_OR_LINK = re.compile(
    r"https?://\S+|\b(?:www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:com|net|org|io|co|info|biz|us|uk|ru|xyz)\b(?:/\S*)?",
    re.I | re.ASCII,
)


def cleaned(s):
    return BLANKS.sub(" ", unicodedata.normalize("NFKC", s)).strip(" ")


def lowered(s):
    return re.sub(r"\S+@\S+", " ", s.lower())


@pytest.fixture(scope="module")
def texts(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "doc_id long, raw string").repartition(8)
    return signals.with_clean_text(df).cache()


def test_clean_and_low(texts):
    for r in texts.collect():
        assert r["text"] == cleaned(r["raw"])
        assert r["low"] == lowered(r["text"])


def test_clean_is_idempotent_and_null_is_empty(spark, texts):
    again = texts.select("text", clean.clean_text(F.col("text")).alias("again"))
    assert again.where("text <> again").count() == 0
    assert spark.sql("select cast(null as string) raw").select(clean.clean_text(F.col("raw"))).first()[0] == ""


def test_stable_class_holds_only_characters_nfkc_keeps():
    stable = re.compile(f"[{clean.NFKC_STABLE}]")
    chars = [c for c in map(chr, range(sys.maxunicode + 1)) if stable.match(c)]
    assert len(chars) > 20000
    assert all(unicodedata.normalize("NFKC", c) == c and unicodedata.combining(c) == 0 for c in chars)
    # Nothing composes unless its second character combines or is a Hangul or Indic vowel sign.
    seconds = {
        d.split()[1]
        for d in (unicodedata.decomposition(c) for c in map(chr, range(sys.maxunicode + 1)))
        if d and not d.startswith("<") and " " in d
    }
    assert not seconds & {f"{ord(c):04X}" for c in chars}
    assert unicodedata.normalize("NFKC", "".join(chars)) == "".join(chars)


def test_mime_subjects(spark):
    rows = [("=?UTF-8?B?w6l0w6k=?=",), ("=?utf-8?q?caf=C3=A9_x?= tail",), ("=?broken",), ("=?x?B?&&&?=",), ("plain",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").coalesce(1).select(clean.decode_subject(F.col("s"))).collect()]
    assert got[:3] == ["été", "café x tail", "=?broken"] and got[4:] == ["plain", ""]


def test_terms_counts_and_words(texts):
    for r in texts.select(
        "low", terms.terms(F.col("low")).alias("t"), terms.term_counts(F.col("low")).alias("c"), terms.alpha_words(F.col("low")).alias("w")
    ).collect():
        toks = [t for t in re.findall("[a-z0-9]+", r["low"]) if len(t) >= 2]
        want = toks + [f"{a} {b}" for a, b in itertools.pairwise(toks)]
        assert r["t"] == want
        assert [(e["term"], e["cnt"]) for e in r["c"]] == sorted(Counter(want).items())
        assert set(r["w"]) == set(re.findall("[a-z]{3,}", r["low"])) and len(r["w"]) == len(set(r["w"]))


def test_short_words_drop_before_pairing(spark):
    df = spark.createDataFrame([("i am a dog",)], "low string")
    assert df.select(terms.terms(F.col("low"))).first()[0] == ["am", "dog", "am dog"]


def test_urls(texts):
    for r in texts.select("low", urls.url_count(F.col("low")).alias("n"), urls.has_url(F.col("low")).alias("any")).collect():
        assert r["n"] == len(HOST_OR_LINK.findall(r["low"])), r["low"]
        assert r["any"] == bool(HOST_OR_LINK.search(r["low"]))


def test_url_pattern_survives_long_hosts(spark):
    texts = [".".join(["ab"] * 20000) + " x.com"]
    texts += ["x.com" + ".y" * n + ".com" for n in (0, 1, 126, 127, 200, 20000)]  # one host, whatever its length
    rows = spark.createDataFrame([(t,) for t in texts], "low string").select(urls.url_count(F.col("low"))).collect()
    assert [r[0] for r in rows] == [1] * len(texts)
    empty = ["a..com", "a.b..com/x y.org", "a.com..b.net", "..", "x.com/a..b.org"]
    rows = spark.createDataFrame([(t,) for t in empty], "low string").select(urls.url_count(F.col("low"))).collect()
    assert [r[0] for r in rows] == [0, 1, 2, 0, 1]


def test_lexicon_terms_start_at_a_word(texts):
    words = ["clown", "here", "log in", "locked", "dog", "a.b", "12"]
    table = texts.sparkSession.createDataFrame([("k", w) for w in words], "kind string, term string")
    joined = {}
    for r in lexicon.lexicon_matches(texts, table).collect():
        joined.setdefault(r["doc_id"], set()).add(r["term"])
    for r in texts.select("doc_id", "low", lexicon.hits(F.col("low"), words).alias("h")).collect():
        want = [w for w in words if re.search("(?:^|[^a-z0-9])" + re.escape(w), r["low"])]
        assert r["h"] == want
        assert joined.get(r["doc_id"], set()) == set(want)


def test_a_lexicon_too_large_to_broadcast(spark, monkeypatch):
    """300,000 terms, one of them at the start of a third of all texts; the same rows as by broadcast."""
    rng = random.Random(9)
    entries = [("long", f"term {i:x} {rng.random():.3f}") for i in range(300_000)] + [("k", "common"), ("j", "common"), ("k", "com"), ("k", "x"), ("k", "")]
    table = spark.createDataFrame(entries, "kind string, term string").repartition(4)
    rows = [(i, "common words and " + entries[rng.randrange(300_000)][1] if i % 3 == 0 else f"some {i} text xx") for i in range(600)] + [(None, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, low string")
    dealt = lexicon.lexicon_matches(docs, table)
    assert "broadcast" not in dealt._jdf.queryExecution().logical().toString().lower()
    got = sorted(map(tuple, dealt.collect()), key=str)
    monkeypatch.setattr("lexigauge.config.BROADCAST_ROWS", 10**6)
    sent = lexicon.lexicon_matches(docs, table)
    assert "broadcast" in sent._jdf.queryExecution().logical().toString().lower()
    assert got == sorted(map(tuple, sent.collect()), key=str)
    assert sum(1 for _, kind, term in got if term == "common") == 400 and sum(1 for _, kind, _ in got if kind == "long") == 200


def test_signals(texts):
    lex = {"urgency": ("clown", "locked"), "cta": ("here", "log in")}
    for r in signals.with_signals(texts, lex).collect():
        t = r["text"]
        words = len(t.split(" ")) if t else 0
        letters, caps = len(re.findall("[A-Za-z]", t)), len(re.findall("[A-Z]", t))
        punct = t.count("!") + t.count("?")
        assert (r["words"], r["split_words"], r["chars"]) == (words, len(t.split(" ")), len(t))
        assert (r["letters"], r["caps"], r["punct"], r["excl"]) == (letters, caps, punct, t.count("!"))
        assert r["caps_ratio"] == (caps / letters if letters else 0.0)
        assert r["punct_per_100w"] == pytest.approx(100 * punct / max(words, 1))
        assert (r["urgency_terms"], r["cta_terms"]) == (len(r["urgency_hits"]), len(r["cta_hits"]))


def test_rounding_equals_python(spark):
    import random

    rng = random.Random(1)
    values = [2.675, 0.35, 0.5, 1.5, 2.5, -0.35, 1234567.25, 0.0, 99.95] + [rng.uniform(-2000, 2000) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", *[exprs.round_half_even(F.col("x"), d).alias(f"d{d}") for d in (0, 1, 2, 3)]).collect():
        for d in (0, 1, 2, 3):
            assert r[f"d{d}"] == round(r["x"], d)


def test_stop_words_are_the_ones_of_mllib(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(config.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_urls_of_many_shapes(spark):
    """Edges, empty labels, schemes inside runs and paths, in all orders."""
    rng = random.Random(1)
    pieces = [
        "a", "b1", ".", "..", ".com", ".co", ".io", "com", "-", "_", "__", "/", "://", "http", "https", "http://", "https://x", "é", "お", " ", "@", "\x01",
        "www.", "x.org", "y.net/",
    ]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    frame = spark.createDataFrame([(t,) for t in made], "low string")
    got = frame.select("low", urls.url_count(F.col("low")).alias("n"), urls.has_url(F.col("low")).alias("any")).collect()
    assert [(t, n, a) for t, n, a in got] == [(t, len(HOST_OR_LINK.findall(t)), bool(HOST_OR_LINK.search(t))) for t in made]


@pytest.mark.parametrize("text, n", [("a." * 500_000 + " see x.com", 1), ("a-" * 500_000 + ".com", 1), ("." * 1_000_000 + "a.com", 1), ("_a." * 300_000 + "com_", 0), ("http://" * 150_000, 1)])
def test_urls_take_linear_time(spark, text, n):
    """A megabyte without any URL, or with one at its end. A pattern that starts anew at every label takes hours."""
    frame = spark.createDataFrame([(text,)], "low string").cache()
    frame.count()
    started = time.monotonic()
    assert frame.select(urls.url_count(F.col("low"))).first()[0] == n
    assert time.monotonic() - started < 20
