"""Reports made from the tables of a folder."""

import pytest

from workload import tables as T


@pytest.fixture()
def folder(spark, tmp_path):
    docs = [(1, "some words here", "es", "src7"), (2, "", "fr", None), (None, "no number", "en", "src1"), (1, "again", "en", "src1"), (9, None, None, None)]
    lines = [(1, 2, 10, 20), (1, 1, 11, 21), (2, 7, 12, 22), (3, 1, 13, 23), (4, 1, 14, 24), (None, 1, 15, 25)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("sent", [0, 100])
def test_only_orders_of_documents_are_listed(spark, folder, monkeypatch, sent):
    """The lines of all orders used to be gathered, also where no document has the number."""
    monkeypatch.setattr(T, "SENT_IDS", sent)
    reports = T.full_reports(spark, folder)
    assert "LeftSemi" in reports._jdf.queryExecution().optimizedPlan().toString()
    first = "[{'from_id': 11, 'to_id': 21}, {'from_id': 10, 'to_id': 20}]"
    got = sorted(map(str, ((r["doc_id"], r["id_1"], r["relations"]) for r in reports.collect())))
    want = [(1, 11, first), (1, 11, first), (2, 12, "[{'from_id': 12.5, 'to_id': 22},]"), (9, 9, None), (None, None, None)]
    assert got == sorted(map(str, want))
