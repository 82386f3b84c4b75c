import hashlib
import random

import numpy as np
import pytest
import tiktoken

P = pytest.importorskip("public_tokenizers")
from lexigauge.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_ids_equal_those_of_the_library_and_decode_to_the_text(spark, documents, reference):
    encoded = bpe.encode(documents, PATH, P.PATTERN)
    rows = bpe.decode(encoded, PATH, P.PATTERN, keep=["doc_id", "text", "ids", "kept"]).collect()
    assert len(rows) == documents.count()
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
        assert r["kept"] == "x"


def test_any_mix_of_spaces_and_scripts(reference):
    rng = random.Random(1)
    pieces = [" ", "  ", "\n", "\t", "a", "b", "the", "ing", "'s", "'ll", "'", "é", "é ", "ß", "漢", "1", "23", "!", "...", "\u2003", "\u3000", "\xa0", "\x1c", "\x85", "<|endoftext|>", "\U0001f600", "\u0301", " The", "|", ".\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 5000, "\n" * 700 + "x", "abcdefgh" * 400, "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000)), ""]
    codec = bpe.codec(PATH, P.PATTERN)
    flat, ends = codec.encode([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert flat[ends[i] : ends[i + 1]].tolist() == reference.encode_ordinary(text), text[:40]
    data, at = codec.decode(flat, ends)
    assert [data[at[i] : at[i + 1]].tobytes().decode() for i in range(len(texts))] == texts


def test_run_tables_stay_right_when_they_are_cut_back_or_hashes_meet(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "SLICE", 400)
    monkeypatch.setattr(bpe, "_INVERSE", 0)
    bpe._powers.cache_clear()
    codec = bpe.Codec(PATH, P.PATTERN)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdef") * rng.randint(1, 9) for _ in range(50)) for _ in range(40)]
    for _ in range(2):
        flat, ends = codec.encode([t.encode() for t in texts])
        assert [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [reference.encode_ordinary(t) for t in texts]
        data, _ = codec.decode(flat, ends)
        assert data.tobytes() == "".join(texts).encode()
    bpe._powers.cache_clear()


def test_unknown_ids_are_an_error_and_null_lists_are_empty(spark):
    codec = bpe.codec(PATH, P.PATTERN)
    with pytest.raises(ValueError):
        codec.decode(np.array([50256], np.int32), np.array([0, 1]))
    frame = spark.createDataFrame([(1, None), (2, []), (3, [0])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(frame, PATH, P.PATTERN).orderBy("doc_id").collect()] == [b"", b"", b"!"]


def test_empty_table(no_documents):
    assert bpe.decode(bpe.encode(no_documents, PATH, P.PATTERN), PATH, P.PATTERN).count() == 0


def test_query_digests(spark, documents, tmp_path, reference):
    from lexigauge.llm.queries import op1_byte_bpe

    documents.write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for r in documents.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    for r in op1_byte_bpe(spark, str(tmp_path)).filter("doc_id IS NOT NULL").collect():
        assert tuple(r)[1:] == want[r["doc_id"]]
