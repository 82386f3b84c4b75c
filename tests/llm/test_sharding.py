import zlib
from collections import Counter

from lexigauge.llm import sharding


def test_counts_differ_by_one_and_slots_have_no_gaps(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 1)
    rows = sharding.shards(documents, keep=["doc_id", "text", "n_words"]).collect()
    assert len(rows) == documents.count()
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) <= set(range(16))
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_reruns_agree_and_few_rows_move(spark):
    frame = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    one = {r["doc_id"]: r["shard"] for r in sharding.shards(frame, keep=["doc_id"]).collect()}
    again = {r["doc_id"]: r["shard"] for r in sharding.shards(frame.repartition(7), keep=["doc_id"]).collect()}
    assert one == again
    grown = {r["doc_id"]: r["shard"] for r in sharding.shards(frame, keep=["doc_id"], n=17).collect()}
    assert sum(one[d] != grown[d] for d in one) / len(one) < 0.2  # 1/17 at the least; a plain modulus moves 16/17


def test_pieces_follow_the_ring_one_key_at_a_time():
    counts, owners, n = [5, 0, 9, 1, 3, 2], [0, 1, 2, 0, 1, 2], 3
    got = {}
    for arc, first, stop, shard, slot in sharding.pieces(counts, owners, n):
        got |= {(arc, rank): (shard, slot + rank - first) for rank in range(first, stop)}
    assert len(got) == sum(counts) and len(set(got.values())) == len(got)
    room, late = [7, 7, 6], []
    want = {}
    for arc, count in enumerate(counts):  # own arcs first
        for rank in range(count):
            if room[owners[arc]]:
                room[owners[arc]] -= 1
                want[arc, rank] = owners[arc]
            else:
                late.append((arc, rank))
    for arc, rank in late:
        step = arc
        while not room[owners[step]]:
            step = (step + 1) % len(counts)
        room[owners[step]] -= 1
        want[arc, rank] = owners[step]
    assert {k: s for k, (s, _) in got.items()} == want


def test_every_hash_lies_on_one_arc():
    ends = [p for p, _ in sharding.ring(16, 8)]
    parts = sharding.segments(ends)
    for h in [0, 1, ends[0], ends[0] + 1, ends[-1], ends[-1] + 1, (1 << 53) - 1, *range(0, 1 << 53, (1 << 53) // 997)]:
        hit = [p for p in parts if p[0] == h >> (53 - sharding.TILE_BITS) and p[2] < h <= p[3]]
        assert len(hit) == 1 and 0 < h - hit[0][4] <= hit[0][5]
        assert hit[0][1] == next((i for i, e in enumerate(ends) if h <= e), 0)


def test_empty_table(no_documents):
    assert sharding.shards(no_documents).count() == 0


def test_shards_equal_the_ring_walked_key_by_key(spark):
    """Every row on its arc; arcs in ring order, then the rows that found their shard full, clockwise."""
    n = 5
    frame = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 7 AS string) AS text")
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(frame, keep=["doc_id"], n=n, points=8).collect()}
    hashes = {r["doc_id"]: r["h"] for r in frame.select("doc_id", sharding.hash53("doc_id").alias("h")).collect()}
    points = sharding.ring(n, 8)
    ends, owners = [p for p, _ in points], [s for _, s in points]
    arc = {d: next((i for i, e in enumerate(ends) if h <= e), 0) for d, h in hashes.items()}
    offset = {d: (h - ends[arc[d] - 1]) % (1 << 53) for d, h in hashes.items()}
    room = [3000 // n + (s < 3000 % n) for s in range(n)]
    shard, late = {}, []
    for d in sorted(arc, key=lambda d: (arc[d], offset[d])):
        if room[owners[arc[d]]]:
            room[owners[arc[d]]] -= 1
            shard[d] = owners[arc[d]]
        else:
            late.append(d)
    for d in late:
        step = arc[d]
        while not room[owners[step]]:
            step = (step + 1) % len(ends)
        room[owners[step]] -= 1
        shard[d] = owners[step]
    assert {d: s for d, (s, _) in got.items()} == shard
    assert len(set(got.values())) == 3000


def test_many_rows_of_one_key_are_cut(spark, monkeypatch):
    """A third of all rows without a key, a third with one; the same text in many of them."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    frame = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id", "CASE WHEN id % 2 = 0 THEN 'same' ELSE cast(id AS string) END AS text"
    )
    placed = sharding.shards(frame)
    rows = placed.collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == 6000 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in counts.items())


def test_clashing_names(documents):
    names = ["span", "first", "tile", "arc", "above", "upto", "shift", "stop", "slot0", "n", "_rank", "_cell"]
    frame = documents.selectExpr("doc_id", "text", "source AS shard", *[f"'x' AS {n}" for n in names])
    got = sharding.shards(frame)
    assert got.columns == ["doc_id", "text", *names, *sharding.RESULTS]
    assert got.filter(" AND ".join(f"`{n}` = 'x'" for n in names)).count() == documents.count()
