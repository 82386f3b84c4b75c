import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lexigauge.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def run(docs, **options):
    return alignment.align_documents(docs, A, B, public_tokenizers.PATTERN, **options)


def test_runs_and_groups_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 60)
        share = rng.choice([0.2, 0.5, 0.95])
        a, b = ({i for i in range(1, n) if rng.random() < share} | {n} for _ in range(2))
        if rng.random() < 0.3:
            b = a
        a, b = sorted(a), sorted(b)
        found = alignment.align(np.array(a), np.array(b))
        both = sorted(set(a) & set(b))
        assert found.ends_a.tolist() == [a.index(x) + 1 for x in both] and found.ends_b.tolist() == [b.index(x) + 1 for x in both]
        starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
        links = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]}
        pairs = list(zip(found.links_a.tolist(), found.links_b.tolist(), strict=True))
        assert set(pairs) == links and len(pairs) == len(links)


def test_lanes_change_nothing(monkeypatch):
    """Long stretches, a long stretch without a common end, and lanes of every length."""
    rng = random.Random(3)
    a = np.unique(np.array([rng.randrange(1, 60_000) for _ in range(20_000)] + [60_000]))
    b = np.unique(np.concatenate([a[(a % 7 > 0) & ((a < 20_000) | (a > 30_000))], np.arange(20_001, 30_000, 3)[::2] * 1, [60_000]]))
    b = b[(b < 40_000) | np.isin(b, a)]
    results = []
    for lane in (8, 64, 256, 10**6):
        monkeypatch.setattr(alignment, "LANE", lane)
        found = alignment.align(a, b)
        results.append((found.ends_a.tolist(), found.ends_b.tolist(), sorted(zip(found.links_a.tolist(), found.links_b.tolist(), strict=True))))
    assert all(r == results[0] for r in results)
    both = np.intersect1d(a, b)
    assert results[0][0] == (np.searchsorted(a, both) + 1).tolist() and results[0][1] == (np.searchsorted(b, both) + 1).tolist()
    assert len(results[0][2]) == len(np.union1d(a, b)) and len(alignment._lanes(a, b)[0]) == 1


ODD = [
    "", " ", "  two  spaces ", "tab\tand\nlines\r\n\r\n", "it's we'll 'S 12 345 ½ ② é é ﬁ Å", "▁ under ▁", "<0x41> <s> <unk> <|endoftext|>", "\x00\x01", "日本語 テスト",
    "\U0001f600 x\U0001d504", "a" * 3000, "   x　y", "#### ||| $$", "don’t", "​﻿", "aaa   \n   bbb", "x\x85y\x1cz", "İıſß", "́x ́", "٣٤ ५६",
]


def test_ids_of_a_are_those_of_its_own_library():
    """Odd texts, every fiftieth code point between others, and random mixes."""
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    pair = alignment.load(A, B, public_tokenizers.PATTERN)
    rng = random.Random(6)
    pieces = [*ODD, *" \n\t.,'-19aZé", "  ", "the", " of", "'s", "ing", "　", "ß", "日"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    points = [chr(p) for p in range(1, 0x30000, 50) if not 0xD800 <= p < 0xE000]
    texts += ["".join(f"a{c} {c}{c}1" for c in points[i : i + 20]) for i in range(0, len(points), 20)]
    want = [e.ids for e in own.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert pair.encode(texts)[0] == want


def brute(docs):
    """Rows by the contract's words, from the two libraries themselves."""
    own, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    own.encode_special_tokens = True
    letters = alignment._byte_of_letter()
    name = {i: t for t, i in own.get_vocab().items()}
    rows, holds = [], Counter()
    for doc, text in docs:
        whole = (" " + (text or "")).encode()
        a = own.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in name[i]) for i in a]
        bytes_b = [bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [pieces.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append((doc, [], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        place = [{x: k + 1 for k, x in enumerate(side)} for side in ends]
        links, groups, i, j = [], [], 0, 0
        for x in sorted(place[0].keys() & place[1].keys()):
            ni, nj = place[0][x], place[1][x]
            groups.append(",".join(map(str, a[i:ni])) + "|" + ",".join(map(str, b[j:nj])))
            for p in range(i, ni):
                for q in range(j, nj):
                    if ends[0][p] - len(bytes_a[p]) < ends[1][q] and ends[1][q] - len(bytes_b[q]) < ends[0][p]:
                        links.append((a[p], b[q]))
            i, j = ni, nj
        holds.update(set(links))
        rows.append((doc, a, b, groups, links))
    most = Counter()
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (doc, len(a), len(b), len(groups), len(links), sum(holds[p] == most[p[0]] for p in links), sum(holds[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc, a, b, groups, links in rows
        ), key=str,
    )


@pytest.fixture(scope="module")
def mixed(spark, documents):
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate([*ODD, None, ODD[3]])], "doc_id long, text string")
    return documents.selectExpr("*", "'x' AS pair", "'x' AS count", "'x' AS best", "'x' AS links", "'x' AS n_links").unionByName(odd, allowMissingColumns=True)


@pytest.mark.parametrize("hot_pairs", [alignment.HOT_PAIRS, 30, 0])
def test_equals_brute_force_however_many_pairs_are_broadcast(mixed, hot_pairs):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = run(mixed, hot_pairs=hot_pairs)
    assert got.columns == [c for c in mixed.columns if c != "n_links"] + columns[1:5] + columns[5:]
    want = brute([(r["doc_id"], r["text"]) for r in mixed.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == want


def test_empty_tables(no_documents, spark):
    assert run(no_documents).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in run(blank, keep=["doc_id"]).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_very_long_text(spark):
    text = "word and " * 120_000 + "é" * 10_000
    row = run(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"]
