"""The two learned operators: held-out accuracy, brute-force formulas, odd input."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from lexigauge.llm import factorisation, toxicity
from lexigauge.llm.batches import plain
from conftest import prose  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def toxic_corpus(spark, n=1200):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, 80).split(" ")
        bad = rng.random() < 0.2
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "gronk" + rng.choice(["ba", "lo", "mu"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(bad)))
    labels += [(3, None), (None, 1), (4, labels[4][1])]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_documents_are_found_in_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels, train=F.col("doc_id") % 4 != 2)
    rows = toxicity.score(docs, model).join(labels.filter("toxic IS NOT NULL AND doc_id % 4 = 2"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) > 0.97


def test_probabilities_are_those_of_the_formula(spark):
    docs, labels = toxic_corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    data = np.frombuffer(plain(b" " * 6 + b"some gronkba text"), np.uint8)
    ratio = toxicity.byte_ratios(model, data)
    at = toxicity._slots(toxicity.strings_of(data))
    for i in range(len(ratio)):
        share = []
        for c in (0, 1):
            left = model.lower_left[at["lower_left"][i]]
            low = model.lower[at["lower"][i], c] * left[c] + left[2 + c] * model.shared[at["shared"][i]]
            left = model.upper_left[at["upper_left"][i]]
            share.append(model.upper[at["upper"][i], c] * left[c] + left[2 + c] * low)
            assert 0 < share[-1] <= 1.0001
        assert math.isclose(ratio[i], math.log(share[1]) - math.log(share[0]), abs_tol=1e-4)


def test_texts_side_by_side_score_as_alone(spark):
    docs, labels = toxic_corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    texts = [r["text"].encode() for r in docs.limit(20).collect()] + [b"", b"x", b" ", b"gronk" * 3000]
    assert np.allclose(toxicity.ratios(model, texts), np.concatenate([toxicity.ratios(model, [t]) for t in texts]), atol=1e-9)


def test_toxicity_of_odd_rows(spark, documents, no_documents):
    docs, labels = toxic_corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert toxicity.score(no_documents, model).count() == 0
    none = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in toxicity.score(documents, none).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(documents, toxicity.fit(no_documents, labels)).collect()} == {0.0}


def quality_corpus(spark, n=1500):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        text, good = prose(rng, rng.randint(20, 100)), rng.random() < 0.7
        if not good:
            text = [text.upper() + "!!", text.replace(" ", "*** "), text.split(" ")[0] + " same" * 60][i // 3 % 3]
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good)))
    labels += [(3, None), (None, 1)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_is_learned(spark):
    docs, labels = quality_corpus(spark)
    model = factorisation.fit(docs, labels, train_rows=F.col("doc_id") % 3 != 1, meta=[F.col("n_chars") > 100])
    scored = factorisation.score(docs, model, keep=["doc_id", "lang"], meta=[F.col("n_chars") > 100])
    rows = scored.join(labels.filter("quality IS NOT NULL AND doc_id % 3 = 1"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97


def test_scores_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    model = factorisation.Model(0.3, rng.normal(size=factorisation.INPUTS), rng.normal(size=(factorisation.INPUTS, 3)))
    texts = [b"some words here. some more", b"", b"A B c"]
    made = [factorisation.inputs(t, ["m"]) for t in texts]
    sizes = np.array([len(a) for a, _ in made])
    got = factorisation.raw_scores(model, np.concatenate([a for a, _ in made]), np.concatenate([x for _, x in made]), np.cumsum(sizes) - sizes)
    for (at, x), score in zip(made, got, strict=True):
        want = model.bias + sum(model.weights[i] * v for i, v in zip(at, x, strict=True))
        for i in range(len(at)):
            for j in range(i):
                want += model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j]
        assert math.isclose(score, want, rel_tol=1e-9)


def test_quality_of_odd_rows(spark, documents, no_documents):
    docs, labels = quality_corpus(spark, 300)
    meta = [F.col("n_chars")]
    model = factorisation.fit(docs, labels, meta=meta, sample=200)
    rows = factorisation.score(documents, model, meta=meta).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert factorisation.score(no_documents, model, meta=meta).count() == 0
    assert {r["score"] for r in factorisation.score(documents, factorisation.fit(no_documents, labels)).collect()} == {0.5}
    only = factorisation.fit(docs, labels.filter("quality = 1"))
    assert all(r["score"] > 0.99 for r in factorisation.score(documents, only).collect())


def test_strings_are_counted_each_for_itself(spark):
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    docs = [(i, 2 * bytes(letters[rng.integers(0, 26, 60_000)]).decode(), "en", "s", 0) for i in range(40)]
    docs += [(100 + i, "zyxwqv zyxwqv " * 3 + "some more words", "en", "s", 0) for i in range(60)]
    labels = [(d[0], int(d[0] >= 100)) for d in docs]
    model = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))
    strings = toxicity.strings_of(np.frombuffer(b"zyxwqv zyxwqv", np.uint8))
    known = [s for s in strings if not any(int(s).to_bytes(6, "big").decode() in d[1] for d in docs[:40])]
    assert len(known) >= 6
    upper = model.upper[toxicity._slots(np.array(known, np.uint64))["upper"]]
    assert (upper[:, 0] == 0).all() and (upper[:, 1] > 0).all()


def test_toxicity_of_chunks_is_that_of_one_process(spark, documents, tmp_path):
    docs, labels = toxic_corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(documents, model)
    rows = scored.collect()
    x = toxicity.ratios(model, [(r["text"] or "").encode() for r in rows])
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-(model.curve[0] + x @ model.curve[1:]))), atol=1e-4)
    docs.write.parquet(f"{tmp_path}/docs")
    scored = toxicity.score(spark.read.parquet(f"{tmp_path}/docs"), model)
    assert len(scored.collect()) == docs.count()
    assert "ReusedExchange" in scored._jdf.queryExecution().executedPlan().toString()  # texts are shuffled once


def test_every_labelled_document_is_counted(spark):
    docs, labels = toxic_corpus(spark, 120)
    model = toxicity.fit(docs, labels, curve_rows=5)
    known = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = [b" " * 5 + plain(r["text"].encode()) + b" " * 5 for r in docs.join(known, "doc_id").collect()]
    wanted, n = np.unique(np.concatenate([toxicity.strings_of(np.frombuffer(t, np.uint8)) for t in texts]), return_counts=True)
    got = {r["string"]: r["n0"] + r["n1"] for r in model.counts.collect()}
    assert got == dict(zip(wanted.tolist(), n.tolist(), strict=True))  # no string reaches from a text into the next


def test_counts_do_not_depend_on_neighbours(spark, documents):
    rows = documents.select("text", F.lit(1).alias("toxic"))
    counts = [sorted(map(tuple, toxicity.count_strings(rows.repartition(n), "text", "toxic").collect())) for n in (1, 6)]
    assert counts[0] == counts[1]


def test_common_middle_bytes_are_dealt_to_several_buckets(spark, documents, monkeypatch):
    docs, labels = toxic_corpus(spark, 200)
    model = toxicity.fit(docs, labels)
    whole = {(r["doc_id"], r["text"]): r["score"] for r in toxicity.score(documents, model).collect()}
    monkeypatch.setattr(toxicity, "BUCKET_STRINGS", 20)
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 30_000)
    n = -(-model.n_strings // 20)
    buckets = toxicity.buckets_of(model.counts, model.n_strings, n)
    assert len(buckets.hot) > 3 and buckets.parts.max() > 1
    strings = np.array([r["string"] for r in model.counts.collect()])
    held = {(int(s), int(b)) for places, at in buckets.holding(strings) for s, b in zip(strings[places], at, strict=True)}
    for chunk in (0, 1, 5, 12_345):
        assert {(int(s), int(b)) for s, b in zip(strings, buckets.asked(strings, chunk), strict=True)} <= held
    dealt = {(r["doc_id"], r["text"]): r["score"] for r in toxicity.score(documents, model).collect()}
    assert dealt.keys() == whole.keys() and all(abs(dealt[k] - whole[k]) < 1e-6 for k in whole)


def test_every_chunk_has_a_partition_for_itself(spark):
    for n in (1, 2, 17, 200):
        keys = toxicity._chunk_keys(spark, n)
        at = spark.createDataFrame([(int(k),) for k in keys], "k long").select(F.pmod(F.hash("k"), F.lit(n)).alias("p")).collect()
        assert [r["p"] for r in at] == list(range(n))
