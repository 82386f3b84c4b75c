from fractions import Fraction

from pyspark.sql import functions as F

from lexigauge.llm import mixing


def want_targets(sizes: dict, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    """Share by weight; sources above their limit stop there; share the rest again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while True:
        level = Fraction(left) / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ -= above


def test_budgets_are_exact(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count() and {r["kept"] for r in rows} == {"x"}
    sizes = {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").split(" ") and [w for w in _words(r["text"] or "")])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    goals = want_targets(sizes)
    for source, size in sizes.items():
        mine = [r for r in rows if r["source"] == source]
        assert {r["source_size"] for r in mine} == {size}
        assert all(abs(r["target"] - float(goals[source])) < 1e-6 * max(size, 1) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - goals[source]) <= 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)


def _words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_reruns_agree_and_the_order_of_rows_does_not_matter(spark, documents):
    one = mixing.mix(documents, keep=["doc_id"]).orderBy("doc_id", "taken").collect()
    other = mixing.mix(documents.repartition(5, F.rand(1)), keep=["doc_id"]).orderBy("doc_id", "taken").collect()
    assert one == other


def test_draw_repeats_and_cuts_at_the_exact_word(spark, documents):
    mixed = mixing.mix(documents).cache()
    drawn = mixing.draw(mixed)
    assert drawn.columns == [c for c in documents.columns if c != "taken"]
    assert drawn.select(F.sum(mixing.word_count("text"))).first()[0] == mixed.select(F.sum("taken")).first()[0]
    texts = {r["text"] for r in documents.collect()}
    cut = [r["text"] for r in drawn.collect() if r["text"] not in texts]
    assert len(cut) <= 4 and all(any(t and t.startswith(c) for t in texts) for c in cut)  # one per source at most


def test_sources_without_words_and_empty_table(spark, no_documents):
    assert mixing.mix(no_documents).count() == 0
    frame = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(frame, keep=["doc_id"]).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.draw(mixing.mix(frame)).count() == 0


def test_plan_runs_no_python(spark, documents, capsys):
    mixing.mix(documents).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
