"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexvane.config import INFO_KEYWORDS, TARGET, DetectionConfig
from lexvane.functions.aliases import alias_terms
from lexvane.functions.relations import with_relations
from lexvane.functions.text import clean_text, contains_any, normalize_name
from lexvane.operators import dictionary as D
from lexvane.operators import entities as E
from lexvane.operators import evaluate as V
from lexvane.operators import graph as G
from lexvane.operators import match as M
from lexvane.operators import model as L
from lexvane.operators import profile as P
from lexvane.operators.recognizer import recognizer_flag
from lexvane.operators.split import stratified_split
from lexvane.plans.detection import BASELINE, SECTIONS, compare_detectors, detection_features, run_detection, split_rows
from lexvane.sources.reports import check_columns, check_rows, nested_mentions, read_csv, with_row_id
from lexvane.sources.results import write_result
from lexvane.sources.terms import load_or_build_terms, publish_terms
from lexvane.storage import new_path, written
from lexvane.streaming.scoring import match_batches, text_flags, write_available, write_matches
from workload import tables as T

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = DetectionConfig(id_col="doc_id")
# An order of rows that SQL can follow too.
RUN = replace(CONFIG, dictionary_from="train", split_order="pmod(doc_id * 2654435761, 4294967296)", split_order_bits=32)


def q_clean_text(spark, sf):
    return T.cleaned(spark, sf).withColumnRenamed("clean", "clean_text")


def q_normalize_names(spark, sf):
    raw = F.concat_ws("-", F.col("p_brand"), F.col("p_name"), F.concat(F.lit("V_"), F.col("p_size"), F.lit(".0 ")))
    return T.table(spark, sf, "part").select("p_partkey", normalize_name(raw).alias("name"))


def _match(plan: str, whole_word: bool = False, terms=T.benchmark_terms) -> Query:
    def query(spark, sf):
        docs = T.documents(spark, sf)
        flagged = M.dictionary_flag(
            docs, terms(spark, sf), "doc_id", "text", "malware_flag", plan, whole_word
        )
        return flagged.select("doc_id", "malware_flag")

    return query


def q_dictionary_minimize(spark, sf):
    return D.minimal_terms(T.benchmark_terms(spark, sf, 1).union(T.benchmark_terms(spark, sf, 2)))


def q_term_counters(spark, sf):
    words = T.table(spark, sf, "benchmark").select(F.explode(F.split("text", "[ .]")).alias("term"))
    return D.term_counters(words)


def q_keyword_match(spark, sf):
    return T.cleaned(spark, sf).select(
        "doc_id", contains_any(F.col("clean"), INFO_KEYWORDS).alias("has_info_keywords")
    )


def q_entity_gazetteer_flag(spark, sf):
    flagged = M.gazetteer_flag(
        T.documents(spark, sf), T.gazetteer(spark, sf), CONFIG.entity_types, "doc_id", "text"
    )
    return flagged.select("doc_id", "has_info_entities")


def q_entity_unpivot(spark, sf):
    wide = T.wide_orders(spark, sf)
    mentions = E.unpivot_entities(wide, "l_orderkey", ("label", "id")).filter(F.col("id").isNotNull())
    return mentions.select("l_orderkey", "idx", "id", "label")


def q_nested_entities(spark, sf):
    lines = T.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("l_partkey").alias("id"),
                    F.col("l_returnflag").alias("label"),
                    F.col("l_linenumber").cast("bigint").alias("start_offset"),
                    F.col("l_suppkey").alias("end_offset"),
                )
            )
        ).alias("e")
    )
    nested = lines.select("l_orderkey", F.to_json("e").alias("entities"))
    return nested_mentions(nested, "l_orderkey")


def q_span_extract(spark, sf):
    mentions = E.unpivot_entities(T.reports(spark, sf), "doc_id", ("label", "start", "end"), ("text",))
    spans = E.malware_spans(mentions).filter(F.col("name") != "")
    return spans.select("doc_id", "idx", "name")


def q_span_quality(spark, sf):
    return E.span_quality(T.reports(spark, sf), "doc_id")


def q_dictionary_build(spark, sf):
    return D.build_terms(D.malware_names(T.reports(spark, sf), "doc_id"))


def q_alias_clean(spark, sf):
    turns = T.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", F.explode(alias_terms(F.col("text"))).alias("term"))


def q_alias_union(spark, sf):
    names = D.malware_names(T.reports(spark, sf), "doc_id")
    return D.build_terms(names, T.alias_answers(spark, sf))


def q_alias_quality(spark, sf):
    names = D.malware_names(T.reports(spark, sf), "doc_id")
    return D.alias_quality(names, T.alias_answers(spark, sf))


def q_dictionary_store(spark, sf):
    path = new_path(spark, "term-list")
    load_or_build_terms(spark, path, lambda: T.benchmark_terms(spark, sf))
    return load_or_build_terms(spark, path, lambda: T.benchmark_terms(spark, sf))[0]


def q_csv_scan(spark, sf):
    path = new_path(spark, "csv")
    source = T.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", "N/A").otherwise(F.col("role")).alias("role"), "text"
    )
    source.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    read = read_csv(spark, path)
    return read.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")


def q_relations_parse(spark, sf):
    parsed = with_relations(T.relation_texts(spark, sf), "relations", "pairs")
    return G.explode_relations(parsed, "l_orderkey", F.col("pairs"))


def q_total_edges(spark, sf):
    parsed = with_relations(T.relation_texts(spark, sf), "relations", "pairs")
    return parsed.select("l_orderkey", G.total_edges(F.col("pairs")).alias("graph_total_edges"))


def q_node_degree(spark, sf):
    return G.node_degrees(T.edges(spark, sf), "l_orderkey")


def q_labelled_nodes(spark, sf):
    return G.labelled_nodes(T.edges(spark, sf), T.labelled_parts(spark, sf), "l_orderkey")


def q_graph_features_rows(spark, sf):
    texts = T.relation_texts(spark, sf)
    nodes = T.labelled_parts(spark, sf).groupBy("l_orderkey").agg(F.collect_set("node").alias("nodes"))
    records = with_relations(texts.join(nodes, "l_orderkey", "left"), "relations", "r")
    return records.select(
        "l_orderkey",
        G.max_degree(F.col("r"), F.col("nodes")).alias("graph_max_malware_degree"),
        G.total_edges(F.col("r")).alias("graph_total_edges"),
    )


def q_graph_features_edges(spark, sf):
    orders = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return G.graph_features_of_edges(
        orders, T.edges(spark, sf), T.labelled_parts(spark, sf), "l_orderkey"
    )


def q_derive_label(spark, sf):
    return E.derive_label(T.wide_orders(spark, sf)).select("l_orderkey", "true_label")


def q_label_map(spark, sf):
    label = (
        F.when(F.col("p_brand") == "Brand#13", "MALWARE")
        .when(F.col("p_brand") == "Brand#14", " malware")
        .when(F.col("p_brand") != "Brand#15", F.col("p_type"))
    )
    return T.table(spark, sf, "part").select("p_partkey", E.label_map(label).alias("label"))


def q_value_shares(spark, sf):
    shares = P.value_shares(T.table(spark, sf, "events"), "event_type")
    return shares.withColumn("share", F.round("share", 9))


def q_value_shares_missing(spark, sf):
    seventh = F.when(F.col("user_id") % 7 != 0, F.floor(F.col("value") / 10).cast("double"))
    value = F.when(F.col("user_id") % 5 == 0, F.lit(float("nan"))).otherwise(seventh)
    shares = P.value_shares(T.table(spark, sf, "events").select(value.alias("v")), "v")
    return shares.withColumn("share", F.round("share", 9))


def q_numeric_summary(spark, sf):
    summary = P.numeric_summary(T.table(spark, sf, "events"), ["value", "user_id"])
    return summary.select("column", "count", *(F.round(c, 6).alias(c) for c in summary.columns[2:]))


def q_class_counts(spark, sf):
    return P.class_counts(T.table(spark, sf, "labels"), "toxic")


def q_stratified_split(spark, sf):
    order = F.pmod(F.col("doc_id") * F.lit(2654435761), F.lit(4294967296))
    labels = T.table(spark, sf, "labels").select("doc_id", "toxic")
    return stratified_split(labels, "doc_id", "toxic", 0.2, order=order, order_bits=32)


def _split_counts(strata: str | None) -> Query:
    def query(spark, sf):
        labels = T.table(spark, sf, "labels").select("doc_id", "toxic")
        split = stratified_split(labels, "doc_id", strata, 0.2)
        keys = ["toxic", "is_test"] if strata else ["is_test"]
        return split.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    return query


def q_scale_features(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    scaling = L.fit_scaling(lines, ["l_quantity", "l_tax"])
    return scaling.apply(lines).withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


def q_class_weights(spark, sf):
    return L.class_weights(T.table(spark, sf, "labels"), "toxic").withColumn("weight", F.round("weight", 9))


def _scored(spark, sf) -> DataFrame:
    """Labelled documents with the flag of the benchmark dictionary."""
    labels = T.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return _match("auto")(spark, sf).join(labels, "doc_id")


def q_confusion_matrix(spark, sf):
    return V.confusion_grid(_scored(spark, sf), "label", "malware_flag")


def q_classification_report(spark, sf):
    report = V.classification_report(_scored(spark, sf), "label", "malware_flag")
    return report.select("class", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")), "support")


def q_leakage_check(spark, sf):
    features = q_graph_features_edges(spark, sf)
    return V.leakage_check(features.join(q_derive_label(spark, sf), "l_orderkey"), "graph_max_malware_degree", "true_label")


def q_detection_features(spark, sf):
    reports = written(T.full_reports(spark, sf), "reports")
    terms = written(D.build_terms(D.malware_names(reports, "doc_id")), "dictionary")
    return detection_features(reports, terms, CONFIG, T.gazetteer(spark, sf))


def q_features_without_entities(spark, sf):
    reports = written(T.full_reports(spark, sf), "reports")
    terms = written(D.build_terms(D.malware_names(reports, "doc_id")), "dictionary")
    return detection_features(reports, terms, CONFIG)


def q_recognizer_flag(spark, sf):
    def load():
        return lambda text: ["ORG"] if "License" in text else ["DATE"]

    docs = T.documents(spark, sf)
    return docs.select("doc_id", recognizer_flag(F.col("text"), load, ("ORG",)).alias("has_info_entities"))


def q_row_guards(spark, sf):
    """Reports with the columns and rows a run needs, numbered where they have no id."""
    reports = check_rows(check_columns(T.full_reports(spark, sf)), 2)
    numbered = with_row_id(reports.withColumnRenamed("doc_id", "own_id"), "row_id")
    return numbered.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("row_id").alias("numbers"))


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


def q_three_way_report(spark, sf):
    features = written(q_detection_features(spark, sf), "features")
    return _rounded(compare_detectors(written(split_rows(features, RUN), "split"), CONFIG).report())


def _run(spark, sf, reports=None):
    reports = written(T.full_reports(spark, sf), "reports") if reports is None else reports
    return run_detection(reports, RUN, entities=T.gazetteer(spark, sf))


def q_detection_run(spark, sf):
    return _rounded(_run(spark, sf).comparison.report())


def _read_back(spark, result: dict) -> DataFrame:
    """The written JSON document of a run: sizes and the three confusion matrices."""
    path = new_path(spark, "result")
    write_result(spark, result, path)
    info, terms = F.col("dataset_info"), F.col("dictionary_info")
    cells = {
        f"{name}_{cell}": F.col(f"{section}.confusion_matrix")[i][j].cast("long")
        for name, section in SECTIONS.items()
        for cell, i, j in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    }
    return spark.read.json(path).select(
        info["initial_rows"].alias("initial_rows"),
        info["train_rows"].alias("train_rows"),
        info["test_rows"].alias("test_rows"),
        terms["size"].alias("terms"),
        F.col("config.min_term_length").alias("min_term_length"),
        F.array_join(F.col("graph_enhanced_evaluation.features_used"), ",").alias("features"),
        *(c.alias(k) for k, c in cells.items()),
    )


def q_result_document(spark, sf):
    return _read_back(spark, _run(spark, sf).result)


def q_one_class_run(spark, sf):
    """Reports without a malware label: models are left out, the dictionary is judged alone."""
    reports = written(T.full_reports(spark, sf), "reports")
    quiet = E.derive_label(reports).filter("true_label = 0").drop("true_label")
    config = replace(RUN, dictionary_from="all")
    run = run_detection(quiet, config, T.benchmark_words(spark, sf), entities=T.gazetteer(spark, sf))
    skipped = sum(m is None for m in run.comparison.models.values())
    ((tn, fp), (fn, tp)) = run.result[SECTIONS[BASELINE]]["confusion_matrix"]
    rows = [(skipped, tn, fp, fn, tp, run.result["dataset_info"]["test_rows"])]
    return spark.createDataFrame(rows, "models_skipped int, tn long, fp long, fn long, tp long, test_rows long")


def q_logistic_fit(spark, sf):
    lines = T.table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    features = ["l_quantity", "l_discount", "l_tax"]
    fit = L.fit_logistic(lines, features, "y")
    rows = [(n, float(w)) for n, w in zip([*features, "intercept"], [*fit.coefficients, fit.intercept])]
    return spark.createDataFrame(rows, "feature string, weight double").withColumn("weight", F.round("weight", 7))


def q_stream_match(spark, sf):
    stream = T.stream(spark, sf, "documents")
    terms = written(D.minimal_terms(T.benchmark_terms(spark, sf)), "terms")
    out, state = new_path(spark, "stream"), new_path(spark, "stream-state")
    write_available(text_flags(stream, terms, "doc_id", "text", INFO_KEYWORDS), out, state).awaitTermination()
    return spark.read.parquet(out)


def q_stream_match_words(spark, sf):
    """All words of the dictionary against the stream, through the index."""
    stream = T.stream(spark, sf, "documents")
    dictionary, out, state = (new_path(spark, n) for n in ("dictionary-versions", "stream", "stream-state"))
    publish_terms(T.benchmark_words(spark, sf), dictionary)
    write_matches(stream, match_batches(dictionary, out, "doc_id", "text", INFO_KEYWORDS), state).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "malware_flag", "has_info_keywords")


def queries() -> dict[str, Query]:
    found = {name[2:]: value for name, value in globals().items() if name.startswith("q_")}
    return found | {
        "dictionary_match": _match("auto"),
        "dictionary_match_scan": _match("scan"),
        "dictionary_match_indexed": _match("indexed"),
        "dictionary_match_shuffled": _match("shuffled"),
        "dictionary_match_whole_word": _match("auto", True),
        "dictionary_match_words": _match("auto", False, T.benchmark_words),
        "stratified_split_counts": _split_counts("toxic"),
        "plain_split_counts": _split_counts(None),
    }
