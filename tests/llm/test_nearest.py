import numpy as np

from lexigauge.llm import nearest


def brute(rows, asked, k):
    """A sorted list of (query id, rank, id, score); equal rows are one query."""
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, vector in {r: None for r in usable if r[0] in asked}:
        own = usable.index((q, vector))
        scores = []
        for n, (i, v) in enumerate(usable):
            if n != own and len(v) == len(vector):
                s = 0.0
                for a, b in zip(vector, v, strict=True):
                    s += a * b
                if not np.isnan(s):
                    scores.append((-s, i))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "VECTOR_ROWS", 30)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 8)
    monkeypatch.setattr(nearest, "GROUPS_PER_CORE", 1)
    rng = np.random.default_rng(1)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    vectors += [(400 + i, vectors[7][1]) for i in range(150)]  # one vector many times
    vectors += [(600 + i, [float(x) for x in rng.normal(size=3)]) for i in range(5)]  # another length
    vectors += [(700, None), (701, [0.0] * 8), (702, [float("nan")] * 8), (703, [1.0] * 7 + [None]), (704, [float("inf")] * 8), (None, [1.0] * 8), (705, []), vectors[0], (1, [9.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, score string")
    got = nearest.search(frame, frame.filter("vec_id % 20 = 0 OR vec_id > 699"), 10)
    queries = {i for i, _ in vectors if i is not None and (i % 20 == 0 or i > 699)}
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors, queries, 10)


def test_rows_that_share_an_id_all_count(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [0.5, 0.3]), (0, [1.0, 1.0]), (0, [2.0, -1.0])] + [(3, [0.1, 0.1])] * 40
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 3, 20):
        got = nearest.search(frame, frame.filter("vec_id IN (0, 3)"), k)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, {0, 3}, k)


def test_very_large_and_very_small_components(spark, monkeypatch):
    monkeypatch.setattr(nearest, "VECTOR_ROWS", 4)
    monkeypatch.setattr(nearest, "GROUPS_PER_CORE", 1)
    rng = np.random.default_rng(5)
    rows = [(0, [1e200, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.3]), (3, [5e-324, 5e-324]), (4, [1e-310, -2e-310]), (5, [1e308, 1e308]), (6, [-1e308, 1e308]), (7, [1e-200, 1e-200])]
    rows += [(10 + i, [float(x) * 10.0 ** int(e) for x, e in zip(rng.normal(size=2), rng.integers(-320, 300, size=2), strict=True)]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 4):
        got = nearest.search(frame, frame, k)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, {i for i, _ in rows}, k)


def test_fewer_candidates_than_asked_for_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest.search(frame, frame.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1, 4.0)]
    assert nearest.search(frame.filter("false"), frame, 5).count() == 0
    assert nearest.search(frame, frame.filter("false"), 5).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(200, 64)), rng.normal(size=(300, 64)) * rng.exponential(size=(300, 1))
    (cx, sx, nx, lx), (cy, sy, ny, ly) = nearest.quantise(x), nearest.quantise(y)
    near = (cx.astype(float) @ cy.astype(float).T) * sx[:, None] * sy
    assert (np.abs(near - x @ y.T) <= lx[:, None] * (ny + ly) + nx[:, None] * ly + 1e-9).all()
    codes, scale, norm, lost = nearest.quantise(np.array([[5e-324, -5e-324], [1e308, 1e308]]))
    assert np.isfinite(norm[1]) and lost[0] > 0 and not codes[0].any()
