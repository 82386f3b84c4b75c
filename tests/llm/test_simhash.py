import random

import xxhash

from pyspark.sql import functions as F

from lexigauge.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    known = sorted(parent)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    return {p: find(p) for p in known}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_components_equal_brute_force(spark, documents):
    rows = simhash.near_duplicates(documents).collect()
    assert len(rows) == documents.count()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    roots = brute_components(set(brute_fingerprint(r["text"]) for r in rows))
    least = {}
    for r in rows:
        p = brute_fingerprint(r["text"])
        assert r["fingerprint"] == signed(p)
        if r["doc_id"] is not None:
            least[roots[p]] = min(least.get(roots[p], r["doc_id"]), r["doc_id"])
    for r in rows:
        assert r["component_id"] == least.get(roots[brute_fingerprint(r["text"])])
    assert prints and simhash.hex_of(F.col("fingerprint")) is not None


def test_no_link_is_lost_or_made_up(spark):
    rng = random.Random(9)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for d in (1, 2, 3, 3, 3, 4, 5):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), d)))
        prints |= {base ^ (1 << b) for b in rng.sample(range(64), 5)}  # a crowd around one fingerprint
    prints |= {0, 7, (1 << 64) - 1}
    chain = rng.getrandbits(64)  # a long chain of links
    for b in range(0, 60, 3):
        chain ^= 0b111 << b
        prints.add(chain)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long").repartition(4)
    edges = simhash.links(frame)
    assert all((r["a"] ^ r["b"]).bit_count() <= 3 or ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in edges.collect())
    roots = {r["v"]: r["root"] for r in simhash.components(edges).collect()}
    want = brute_components(prints)
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(signed(p))
    for group in groups.values():
        assert {roots.get(p, p) for p in group} == {min(group)}


def test_one_document_of_each_group_stays(spark, documents):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    rows = simhash.near_duplicates(documents).collect()
    groups = {(r["component_id"], r["fingerprint"] if r["component_id"] is None else 0) for r in rows}
    got = kept.collect()
    assert len(got) == len(groups)
    assert {r["doc_id"] for r in got} == {g for g, _ in groups}


def test_empty_table(no_documents):
    assert simhash.near_duplicates(no_documents).count() == 0
    assert simhash.keep_one(no_documents).count() == 0


def test_hex(spark):
    frame = spark.createDataFrame([(-1,), (0,), (255,)], "fingerprint long")
    assert [r[0] for r in frame.select(simhash.hex_of(F.col("fingerprint"))).collect()] == ["f" * 16, "0" * 16, "0" * 14 + "ff"]


def test_one_of_linked_documents_without_keys_stays(spark):
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words[::-1])]
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    apart = [((prints[0] ^ p) & (2**64 - 1)).bit_count() for p in prints]
    assert 0 < apart[1] <= simhash.MAX_BITS < apart[2]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 2
