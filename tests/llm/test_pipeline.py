import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from lexigauge.llm import simhash  # noqa: E402
from conftest import prose  # noqa: E402
from test_bpe import PATH, P, bpe, tiktoken  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(600):
        text = prose(rng, rng.randint(60, 120))
        toxic = i % 6 == 0
        if toxic:
            text = " ".join(w if j % 9 else "gronk" + w for j, w in enumerate(text.split(" ")))
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(700 + i, docs[1][1], "en", "s1", 1) for i in range(30)] + [(800, None, None, None, None), (801, "", "en", "s1", 0), (802, "short", "en", "s1", 5), (803, "# " * 90, "en", "s1", 0), docs[2]]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_each_stage_takes_effect_on_what_the_one_before_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen[name] = rows
        if name != "tokens":
            assert docs.columns == columns
    first = {r["doc_id"] for r in seen["quality_rules"]}
    assert first.isdisjoint({800, 801, 802, 803}) and len(first & set(range(600))) >= 590
    clean = {r["doc_id"] for r in seen["toxicity"]}
    assert sum(i in clean for i in range(0, 600, 6)) <= 3 and sum(i in clean for i in range(600) if i % 6) >= 490
    kept = [r["doc_id"] for r in seen["near_duplicates"]]
    assert len(kept) == len(set(kept)) and not set(kept) & set(range(700, 730)) and 1 in kept
    assert {r["doc_id"] for r in seen["mixing"]} <= set(kept)
    taken = {}
    for r in seen["mixing"]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    size = sum(len(r["text"].split()) for r in seen["near_duplicates"])
    assert abs(sum(taken.values()) - 1.5 * size) <= 3
    encoder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    assert sorted((r["doc_id"], r["ids"]) for r in seen["tokens"]) == sorted((r["doc_id"], encoder.encode_ordinary(r["text"])) for r in seen["mixing"])
    assert simhash.MAX_BITS == 3


def test_run_and_empty_documents(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 300
    spark.read.parquet(f"{folder}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
