import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest

from lexigauge.llm import rules
from conftest import prose  # noqa: E402


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def labelled(spark, n=4000):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.85
        text = prose(rng, rng.randint(60, 90))
        if not good and i % 2:
            text = text.replace(" ", " ### ")
        docs.append((i, text, "en" if i % 20 else None, "s", 0))
        labels.append((i, int(good)))
    labels += [(5, None), (None, 1), (7, 0), (7, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_statistics_equal_brute_force(documents):
    rows = rules.text_statistics(documents).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert tuple(r[n] for n in rules.STATISTICS[:5]) == brute(r["text"])


def test_many_distinct_words_take_the_exact_way(monkeypatch):
    monkeypatch.setattr(rules, "ID_BITS", 2)
    words = b"a b c d e f a b c x y z a b c".split()
    assert rules.repeated_words(words) == 9


def test_tail_is_the_binomial_sum():
    for k, n, p in ((0, 50, 0.05), (3, 400, 0.03), (2, 200, 0.05)):
        q = Fraction(p)
        want = float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
        assert rules.tail(k, n, p) == pytest.approx(want, rel=1e-9)
    assert rules.tail(30, 400, 0.03) == 1.0


def test_sequence_stops_at_the_first_cutoff_that_is_not_certified():
    bad, good = [0, 50, 90, 99], [0, 0, 1, 40]
    assert rules.choose(bad, good, 2000, 0.01, 0.01, 1.0) == 2
    assert rules.choose(bad, good, 100, 0.01, 0.01, 1.0) is None  # too few to certify anything


def test_junk_goes_and_good_documents_stay(spark):
    docs, labels = labelled(spark)
    judged = rules.apply_rules(docs, labels).join(labels.filter("quality IS NOT NULL").distinct(), "doc_id")
    count = {(r["quality"], r["junk"], r["kept"]): r["n"] for r in judged.selectExpr("quality", "text LIKE '%###%' AS junk", "kept").groupBy("quality", "junk", "kept").count().withColumnRenamed("count", "n").collect()}
    assert sum(n for (q, _, k), n in count.items() if q and not k) <= 0.03 * sum(n for (q, _, _), n in count.items() if q)
    # Junk of the language with enough labels goes; the small stratum certifies nothing.
    assert count.get((0, True, False), 0) > 0.8 * (count.get((0, True, True), 0) + count.get((0, True, False), 0))


def test_without_labels_only_the_base_rules_reject(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = rules.apply_rules(documents, none).collect()
    assert len(rows) == documents.count()
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


def test_empty_table(spark, no_documents):
    assert rules.apply_rules(no_documents, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0
