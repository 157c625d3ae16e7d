"""Every query against its SQL counterpart on the smallest given tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 8) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    got = entry.queries()[name](spark, SF)
    want = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    left = sorted(repr(tuple(plain(v) for v in r)) for r in got.select(*columns).collect())
    right = sorted(repr(tuple(plain(v) for v in r)) for r in want.fetchall())
    assert left == right


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_models_are_reported(spark):
    rows = entry.queries()["three_way_report"](spark, SF).collect()
    assert {r["model"] for r in rows} == {"dictionary_only", "text_flags", "graph"} and len(rows) == 15
