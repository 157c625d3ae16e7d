import json
import os

import pytest
from pyspark.sql import functions as F

from lexvane.config import DetectionConfig
from lexvane.operators.dictionary import minimal_terms
from lexvane.operators.recognizer import recognizer_flag
from lexvane.plans.detection import compare_detectors, detection_features, run_detection
from lexvane.sources import reports as R
from lexvane.sources.results import write_result
from lexvane.sources.terms import load_or_build_terms, read_terms, write_terms
from lexvane.streaming.scoring import score_reports, text_flags, write_available

HEADER = "text,relations,id_1,label_1,start_offset_1,end_offset_1,id_2,label_2,start_offset_2,end_offset_2\n"


def csv_line(i):
    name = ["emotet", "trickbot", "qakbot"][i % 3]
    odd = i % 2
    text = f'The ""{name}"" loader,\nused again {i}' if odd else f"A quiet day number {i}"
    label = "malware" if odd else "TOOL"
    relations = f"[{{'from_id': {i}, 'to_id': {i + 1}}}, {{'from_id': {i}, 'to_id': {i + 2}}}]"
    return f'"{text}","{relations}",{i}.0,{label},5,{5 + len(name)},NA,N/A,,\n'


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "a.csv").write_text(HEADER + "".join(map(csv_line, range(60))), encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def reports(spark, csv_path):
    return R.with_row_id(R.load_reports(spark, csv_path))


def test_csv_scan(reports):
    row = reports.filter(F.contains("text", F.lit("again 1"))).orderBy("row_id").first()
    assert row["text"] == 'The "trickbot" loader,\nused again 1'
    assert row["label_2"] is None and row["id_2"] is None
    assert reports.count() == 60 and reports.select("row_id").distinct().count() == 60


def test_contract(spark):
    with pytest.raises(ValueError, match="relations, id_1"):
        R.check_columns(spark.createDataFrame([("x",)], "text string"))
    with pytest.raises(ValueError, match="fewer than 2"):
        R.check_rows(spark.range(1), 2)


def test_term_store(spark, tmp_path):
    path = str(tmp_path / "terms")
    terms = spark.createDataFrame([("zeta",), ("w32/virlock",), ("été",), ("alpha",)], "term string")
    first, loaded = load_or_build_terms(spark, path, lambda: terms)
    assert not loaded and first.count() == 4
    again, loaded = load_or_build_terms(spark, path, lambda: pytest.fail("built again"))
    assert loaded and {r[0] for r in again.collect()} == {"zeta", "w32/virlock", "été", "alpha"}
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    lines = "".join((tmp_path / "terms" / f).read_text(encoding="utf-8") for f in parts).split()
    assert lines == ["alpha", "w32/virlock", "zeta", "été"]
    assert not write_terms(terms.limit(0), str(tmp_path / "none")) and not os.path.exists(tmp_path / "none")


def test_term_file_is_taken_as_it_is(spark, tmp_path):
    (tmp_path / "t.txt").write_text("  Ab-C \n\n \nab-c\nxy\nxy\n", encoding="utf-8")
    assert {r[0] for r in read_terms(spark, str(tmp_path / "t.txt")).collect()} == {"Ab-C", "ab-c", "xy"}


def test_blank_store_is_built_again(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n \n", encoding="utf-8")
    built, loaded = load_or_build_terms(spark, str(tmp_path / "t.txt"), lambda: spark.createDataFrame([("abcd",)], "term string"))
    assert not loaded and built.count() == 1


@pytest.mark.parametrize("source", ["all", "train"])
def test_whole_run(spark, reports, tmp_path, source):
    config = DetectionConfig(dictionary_from=source)
    run = run_detection(reports, config, source_name="fixture")
    result = run.result
    assert result["dataset_info"]["initial_rows"] == 60 and result["dataset_info"]["test_rows"] == 12
    assert result["dataset_info"]["full_set_derived_label_dist"] == {"0": 0.5, "1": 0.5}
    features = {r["row_id"]: r for r in run.features.collect()}
    assert len(features) == 60
    odd = [r for r in features.values() if r["true_label"]]
    assert all(r["graph_max_malware_degree"] == 2 and r["graph_total_edges"] == 2 for r in odd)
    section = result["graph_enhanced_evaluation"]
    assert section["features_used"] == ["malware_flag", "has_info_keywords", "graph_max_malware_degree", "graph_total_edges"]
    assert section["confusion_matrix"] == [[6, 0], [0, 6]]
    assert section["classification_report_dict"]["accuracy"] == 1.0
    summary = {r["column"]: r for r in run.graph_summary.collect()}
    assert summary["graph_total_edges"]["mean"] == 2.0
    path = str(tmp_path / "result")
    write_result(spark, result, path)
    (part,) = [f for f in os.listdir(path) if f.startswith("part-")]
    read = json.loads((tmp_path / "result" / part).read_text())
    assert read["dictionary_info"] == {"size": 3, "loaded_from_cache": False}
    assert read["config"]["dictionary_cache"] is None
    assert read["nlp_context_enhanced_evaluation"]["confusion_matrix"] == result["nlp_context_enhanced_evaluation"]["confusion_matrix"]


def test_plans_give_the_same_features(spark, reports):
    terms = spark.createDataFrame([("emotet",), ("bot loader",), ("the trick",)], "term string")
    tables = [
        {tuple(r) for r in detection_features(reports, terms, DetectionConfig(match_plan=p)).collect()}
        for p in ("scan", "indexed", "shuffled")
    ]
    assert tables[0] == tables[1] == tables[2] and len(tables[0]) == 60


def test_run_with_recognizer_and_given_terms(spark, reports):
    flag = recognizer_flag(F.col("text"), lambda: lambda t: ["ORG"] if "quiet" in t else [], ("ORG",))
    terms = spark.createDataFrame([("emotet",)], "term string")
    run = run_detection(reports, terms=terms, entity_flag=flag)
    assert "has_info_entities" in run.result["nlp_context_enhanced_evaluation"]["features_used"]
    assert run.features.filter("has_info_entities <> 1 - true_label").count() == 0


def test_empty_dictionary_is_refused(spark, reports):
    with pytest.raises(ValueError, match="empty"):
        run_detection(reports, terms=spark.createDataFrame([], "term string"))


def test_one_class_skips_the_models(spark, reports):
    only = reports.filter(F.col("label_1") == "TOOL")
    run = run_detection(only, terms=spark.createDataFrame([("day",)], "term string"))
    assert run.result["graph_enhanced_evaluation"]["classification_report_dict"] == {"error": "Skipped"}
    assert run.result["dictionary_only_baseline_evaluation"]["confusion_matrix"] == [[0, 6], [0, 0]]


def test_streams_score_like_tables(spark, reports, tmp_path):
    source = str(tmp_path / "in")
    reports.repartition(3).write.parquet(source)
    terms = minimal_terms(spark.createDataFrame([("emotet",), ("emotet loader",), ("qakb",)], "term string"))
    features = detection_features(reports, terms)
    model = compare_detectors(features.withColumn("is_test", F.col("row_id") % 5 == 0), with_entities=False).models["graph"]
    stream = spark.readStream.schema(reports.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for scored, want in [
        (text_flags(stream, terms, "row_id", "text", ("used",)), text_flags(reports, terms, "row_id", "text", ("used",))),
        (score_reports(stream, terms, model), model.predict(features)),
    ]:
        out = str(tmp_path / f"out{len(want.columns)}")
        write_available(scored, out, out + "-state").awaitTermination()
        got = spark.read.parquet(out).select(*want.columns)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and got.count() == 60
