import random
import re
import time

from pyspark.sql import functions as F

from lexigauge.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words, starts, labels = WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        found = [i for i in range(len(words) - len(want) + 1) if words[i : i + len(want)] == want]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = {
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
    "cc by cc by, CC-BY": "cc-by",
    "All rights reserved. all Rights, reserved! all rights": "reserved",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-notice",
    "general public public license": "",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "Licensed under the said Apache License, Version 2.0": "apache-2.0",  # a word put in
    "Permission is hereby granted, free of charge, to any good person obtaining a copy": "mit",
    "permission is granted free": "",
    "the license of the person": "",
    "É cc by ü": "cc-by",
    "cc": "",
}


def test_base_places_equal_brute_force_and_notices_are_found(spark, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(900, "cc by"), (900, "cc by"), (901, " ".join(["all rights reserved cc by"] * 3000))]
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in rows], "doc_id long, text string"))
    got = licenses.scan(frame, keep=["doc_id", "text"]).collect()
    assert len(got) == frame.count()
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(r["text"])
        if r["text"] in TEXTS:
            assert r["labels"] == TEXTS[r["text"]], r
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        for s in r["spans"]:
            assert 0 <= s["start"] < s["end"] <= r["n_words"]


def brute_cover(words, phrase):
    """The largest share of a phrase's word pairs found in order at diagonals that differ by SHIFT at most from one of them."""
    want = phrase.split()
    pairs = list(zip(want, want[1:], strict=False))
    diagonals = {}
    for i, pair in enumerate(zip(words, words[1:], strict=False)):
        for at, other in enumerate(pairs):
            if pair == other:
                diagonals.setdefault(i - at, []).append(at)
    best = 0
    for centre in diagonals:
        near = sorted((min(ats) + d, d, ats) for d, ats in diagonals.items() if abs(d - centre) <= licenses.SHIFT)
        last_pair = last_place = -1
        votes = 0
        for _, d, ats in near:
            for at in [a for a in sorted(ats) if a > max(last_pair, last_place - d)]:
                votes, last_pair, last_place = votes + 1, at, at + d
        best = max(best, votes / len(pairs))
    return best


def brute_labels(text):
    words = WORD.findall((text or "").translate(LOWER))
    covers = {(label, phrase): brute_cover(words, phrase) for label, phrases in licenses.NOTICES.items() for phrase in phrases}
    base = {label for phrase, label in licenses.BASE.items() if brute_cover_exact(words, phrase)}
    labels = base | {label for (label, _), cover in covers.items() if cover >= licenses.COVER}
    return ",".join(sorted(labels)), max([*covers.values(), 1.0 if base else 0.0])


def brute_cover_exact(words, phrase):
    want = phrase.split()
    return any(words[i : i + len(want)] == want for i in range(len(words) - len(want) + 1))


def test_labels_equal_brute_force(spark):
    """Notices whole, with words put in, left out and swapped, in pieces and over and over."""
    rng = random.Random(11)
    phrases = [p for ps in licenses.NOTICES.values() for p in ps] + list(licenses.BASE)
    texts = ["public license " * 4, "license public " * 30, "the software the software", *phrases, " ".join(phrases), " ".join(reversed(" ".join(phrases).split()))]
    for _ in range(300):
        words = []
        for _ in range(rng.randint(1, 4)):
            part = rng.choice(phrases).split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                at = rng.randrange(len(part) + 1)
                change = rng.random()
                if change < 0.4:
                    part[at:at] = [rng.choice(["x", "the", "license", "public"])] * rng.randint(1, 3)
                elif change < 0.8:
                    del part[at : at + rng.randint(1, 3)]
                elif 0 < at < len(part):
                    part[at - 1], part[at] = part[at], part[at - 1]
            words += part + rng.choice([[], ["and"], ["y"] * 3])
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = set()
    for r in licenses.scan(frame, keep=["doc_id", "text"]).collect():
        labels, score = brute_labels(r["text"])
        assert (r["labels"], round(r["score"], 9)) == (labels, round(score, 9)), r
        seen.update(labels.split(","))
        own = {s["label"] for s in r["spans"]}
        assert own == set(filter(None, labels.split(",")))
    assert len(seen) > 9
    by_text = {r["text"]: r for r in licenses.scan(frame, keep=["text"]).collect()}
    assert "lgpl" not in by_text["public license " * 4]["labels"]


def test_spans_are_the_places_of_notices(spark):
    notice = licenses.NOTICES["mit"][1]
    text = "one two " + notice + " three " + notice.replace("free of charge", "free of any charge") + " four"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    n = len(notice.split())
    assert [(s["start"], s["end"]) for s in row["spans"] if s["label"] == "mit"] == [(2, 2 + n), (3 + n, 4 + 2 * n)]


def test_a_megabyte_of_matches(spark):
    texts = ["cc by x y z w q r " * 60_000, "cc by " * 170_000, "public license " * 70_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    started = time.monotonic()
    rows = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    assert time.monotonic() - started < 60
    assert [rows[i]["n_base"] for i in range(3)] == [60_000, 170_000, 0] and rows[2]["labels"] == ""


def test_clashing_names(documents):
    names = ["first", "label", "template", "pairs", "votes", "at", "hash", "mask", "diagonal", "last", "is_base", "w1", "row", "start", "cover"]
    frame = documents.select("doc_id", "text", *[F.lit("x").alias(n) for n in names])
    got = licenses.scan(frame, keep=["doc_id", *names])
    assert got.columns == ["doc_id", *names, *licenses.RESULTS, "spans"]
    assert got.filter(" AND ".join(f"`{n}` = 'x'" for n in names)).count() == documents.count()


def test_empty_table(no_documents):
    assert licenses.scan(no_documents).count() == 0


def test_plan_runs_no_python(documents, capsys):
    licenses.scan(documents).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
