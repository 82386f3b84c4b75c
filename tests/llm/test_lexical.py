import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexigauge.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """{item: [(score, doc), ...]} by the formula over all documents; documents of equal score and key are alike."""
    tfs = [(doc, Counter(terms_of(text))) for doc, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = {}
    for item, terms in asked.items():
        rows = []
        for doc, counts in tfs:
            score = 0
            for t in terms & counts.keys():
                n, tf = sum(counts.values()), counts[t]
                m = 10 + 90 * n * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                rows.append((-score, doc is None, doc))
        rows.sort(key=lambda r: r[:2] if r[1] else r)
        if rows:
            out[item] = [(-s, doc) for s, _, doc in rows[:k]]
    return out


def result(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        rows = out.setdefault(r["item_id"], [])
        assert r["rank"] == len(rows) + 1
        rows.append((r["score"], r["doc_id"]))
    return out


@pytest.fixture(scope="module")
def items(spark, documents):
    texts = [r["text"] for r in documents.filter("text IS NOT NULL").orderBy("doc_id").limit(60).collect()]
    rng = random.Random(8)
    rows = [(i, " ".join(rng.sample(t.split(), min(len(t.split()), 12))).upper()) for i, t in enumerate(texts)]
    rows += [(1, "two WORDS more"), (70, None), (71, ""), (72, "#!"), (73, "wordnowhere"), (None, "one two"), (3, rows[3][1])]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'x' AS score", "'x' AS rank", "1 AS item")


@pytest.mark.parametrize("k", [1, 10])
def test_equals_brute_force(documents, items, k, monkeypatch):
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in items.collect()], k)
    assert {70, 71, 72, 73}.isdisjoint(want) and None in want
    assert result(lexical.search(documents, items, k)) == want


def test_blocks_of_items_and_small_segments_change_nothing(documents, items):
    whole = result(lexical.search(documents, items, 10))
    assert result(lexical.search(documents.repartition(3), items, 10, block_terms=40)) == whole


def test_empty_tables(documents, no_documents, items):
    assert lexical.search(no_documents, items).count() == 0
    assert lexical.search(documents, items.filter("false")).count() == 0
    assert lexical.search(documents.filter("text IS NULL OR text = ''"), items).count() == 0


def test_one_name_for_both_keys(documents, items):
    named = items.select("text", items["item_id"].alias("doc_id"))
    assert lexical.search(documents, named, item_key="doc_id").columns == ["item_doc_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        lexical.search(documents, items, 0)


def _segment(rng, n_docs, n_terms):
    lists = [sorted(rng.sample(range(n_terms), min(n_terms, 1 + int(rng.expovariate(0.2))))) for _ in range(n_docs)]
    table = pa.table({
        "doc": pa.array(range(n_docs)), "n": pa.array([10 + len(x) for x in lists], pa.int64()),
        "terms": pa.array(lists, pa.list_(pa.int32())), "counts": pa.array([[rng.randint(1, 4) for _ in x] for x in lists], pa.list_(pa.int32())),
    })
    return lexical.Segment(table, n_docs, 20 * n_docs, n_terms)


def test_few_accumulators_give_the_same_best():
    rng = random.Random(2)
    fewer = 0
    for _ in range(60):
        segment = _segment(rng, 300, 40)
        df = np.diff(segment.ends)
        weights = np.array([lexical.weight(300, int(n)) for n in df], np.int64)
        terms = np.array(rng.sample(range(40), 12))
        terms = terms[np.lexsort((terms, -weights[terms]))]
        total = np.zeros(300, np.int64)
        for t in terms:
            span = slice(segment.ends[t], segment.ends[t + 1])
            total[segment.docs[span]] += segment.worth[span] * weights[t]
        best = np.lexsort((np.arange(300), -total))[:5]
        best = best[total[best] > 0]
        docs, scores, accumulators = segment.search(terms, weights, 5, 0)
        assert docs.tolist() == best.tolist() and scores.tolist() == total[best].tolist()
        fewer += accumulators < np.count_nonzero(total)
        # A floor below the best score keeps every document that reaches it.
        floor = int(total[best[0]])
        docs, scores, _ = segment.search(terms, weights, 5, floor)
        assert docs.tolist() == [d for d in best.tolist() if total[d] >= floor]
    assert fewer > 0


def test_segments_hold_all_rows(monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", 10)
    rng = random.Random(4)
    lists = [list(range(rng.choice([0, 1, 3, 30]))) for _ in range(200)]
    batch = pa.record_batch({"doc": pa.array(range(200)), "terms": pa.array(lists, pa.list_(pa.int32()))})
    parts = list(lexical._segments(iter([batch.slice(0, 90), batch.slice(90)])))
    assert [d for p in parts for d in p["doc"].to_pylist()] == list(range(200))
    assert all(sum(len(x) + 1 for x in p["terms"].to_pylist()) <= 10 or p.num_rows == 1 for p in parts)


def test_sizes_beyond_64_bits():
    """90 * n * N is computed in Python's integers."""
    table = pa.table({"doc": [1], "n": pa.array([10**9], pa.int64()), "terms": pa.array([[0]], pa.list_(pa.int32())), "counts": pa.array([[5]], pa.list_(pa.int32()))})
    segment = lexical.Segment(table, 10**11, 10**19, 1)
    m = 10 + 90 * 10**20 // 10**19
    assert segment.worth.tolist() == [5 * 10**9 // (5000 + 8 * m)]
