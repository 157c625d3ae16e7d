"""The pipeline and the registered queries on the smallest given tables."""

import os
import re

import pytest

import corpus_pipeline
from lexvane.llm import minhash, queries, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables here")


def test_stages(spark, tmp_path):
    first = docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"] for r in docs.collect()}
        assert kept[name] <= ids
        ids = kept[name]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
        if name == "toxicity":
            model = toxicity.fit(first, spark.read.parquet(f"{SF}/labels.parquet"))
            scores = toxicity.score(first, model).filter("predicted = 0").collect()
            assert kept[name] == {r["doc_id"] for r in scores}
        if name == "near_copies":
            assert kept[name] == {r["doc_id"] for r in minhash.near_duplicates(before).filter("kept").collect()}
        if name == "repeats":
            left = substring_dedup.remove_repeats(before).filter("n_removed < n_words or n_words = 0")
            assert kept[name] == {r["doc_id"] for r in left.collect()}


def test_run_takes_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert rows.filter("n_tokens != size(ids)").count() == 0 and rows.count() > 100


def test_edge_rows_pass_all_stages(spark, docs, empty):
    rows = docs
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
    assert rows.count() > 20
    rows = empty
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
    assert rows.collect() == []


def test_every_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 14))
