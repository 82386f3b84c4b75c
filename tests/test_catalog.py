"""Every registered query against its SQL on the smallest given tables."""

import math
import os

import pytest

import __spark_entry__ as contract

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not found")
QUERIES, SQL = contract.QUERIES, contract.ORACLES
FITS = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, str):
        return value
    return repr(round(float(value), 6) + 0.0)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(comparable(v) for v in r) for r in frame[columns].itertuples(index=False))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert FITS == ["cross_origin_report", "cv_report", "fit_terms", "holdout_report"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = rows(QUERIES[name](spark, SF).toPandas()), rows(duck.execute(SQL[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_holdout_report(spark):
    got = {(r["scope"], r["grp"]): r for r in QUERIES["holdout_report"](spark, SF).collect()}
    assert got["overall", None]["accuracy_pct"] > 70
