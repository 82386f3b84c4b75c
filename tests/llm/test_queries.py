"""The registered queries on the smallest given tables: SQL where there is one, the contracts' columns elsewhere."""

import os

import pytest

from lexigauge.llm.oracles import ORACLES
from lexigauge.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not found")
COLUMNS = {
    "op1_byte_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op2_chat": "conv_id:bigint n_turns:bigint turns_sha256:string loss_chars:bigint loss_sha256:string formatted_chars:bigint",
    "op3_nearest": "query_id:bigint rank:int vec_id:bigint score:double",
    "op4_mixing": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op5_licenses": "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string labels:string score:double",
    "op6_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
    "op7_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op8_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op9_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op10_quality_rules": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op11_lexical_search": "item_id:bigint rank:int doc_id:bigint score:bigint",
    "op12_alignment": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint count_sum:bigint groups_sha256:string",
    "op13_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double accepted:boolean",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    frame = QUERIES[name](spark, SF)
    assert " ".join(f"{n}:{t}" for n, t in frame.dtypes) == COLUMNS[name]
    if name not in ("op2_chat", "op3_nearest", "op11_lexical_search"):
        assert frame.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("conversations", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda f: sorted(map(tuple, f[sorted(f.columns)].itertuples(index=False)))
    assert rows(got) == rows(want)


def test_all_are_registered():
    import __spark_entry__ as contract

    assert set(QUERIES) == {*COLUMNS, "pipeline"} and set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
