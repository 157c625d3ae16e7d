"""A whole detection run: features, split, three detectors, result.

Every stage is usable alone. Features are written once as a narrow table;
profiles, the split, the fits and the evaluations read only that table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.config import (
    CLASS_NAMES,
    ENTITY_FLAG,
    KEYWORD_FLAG,
    MALWARE_FLAG,
    MAX_DEGREE,
    TARGET,
    TOTAL_EDGES,
    DetectionConfig,
)
from lexvane.functions.relations import PAIRS, with_relations
from lexvane.functions.text import clean_text, contains_any
from lexvane.operators.dictionary import build_terms, malware_names, terms_as_text
from lexvane.operators.entities import any_malware, derive_label, entity_array, group_width, malware_ids
from lexvane.operators.evaluate import report_of
from lexvane.operators.graph import max_degree, total_edges
from lexvane.operators.match import TermSet, flag_in_place, flag_sets
from lexvane.operators.model import LogisticFit, fit_logistic
from lexvane.operators.profile import numeric_summary, share_map
from lexvane.operators.split import stratified_split
from lexvane.sources.reports import check_rows, with_row_id
from lexvane.sources.terms import load_or_build_terms
from lexvane.storage import written

BASELINE = "dictionary_only"
TEXT_MODEL = "text_flags"
GRAPH_MODEL = "graph"

# Section names of the written result.
SECTIONS = {
    BASELINE: "dictionary_only_baseline_evaluation",
    TEXT_MODEL: "nlp_context_enhanced_evaluation",
    GRAPH_MODEL: "graph_enhanced_evaluation",
}


def row_features(
    reports: DataFrame,
    cfg: DetectionConfig = DetectionConfig(),
    entity_flag: Column | None = None,
    small_terms: DataFrame | None = None,
) -> DataFrame:
    """Features that need only their own row, without the texts; no shuffle.

    ``entity_flag`` is a 0/1 column over raw texts (a user's recognizer);
    ``small_terms`` a dictionary small enough to test on every row, which adds
    the malware flag. Works on streams too.
    """
    entities = entity_array(reports, ("label",))
    with_ids = entity_array(reports, ("label", "id"))
    if cfg.relations_col in reports.columns:
        parsed = with_relations(reports, cfg.relations_col, "_relations")
    else:
        parsed = reports.withColumn("_relations", F.array().cast(PAIRS))
    staged = parsed.select(
        cfg.id_col,
        clean_text(F.col(cfg.text_col)).alias("_clean"),
        (F.lit(0) if entity_flag is None else entity_flag).alias(ENTITY_FLAG),
        "_relations",
        malware_ids(with_ids).alias("_nodes"),
        any_malware(F.transform(entities, lambda e: e["label"])).alias(TARGET),
    )
    flags = []
    if small_terms is not None:
        staged = flag_in_place(staged, small_terms, "_clean", MALWARE_FLAG, cfg.whole_word)
        flags = [MALWARE_FLAG]
    return staged.select(
        cfg.id_col,
        *flags,
        contains_any(F.col("_clean"), cfg.keywords).alias(KEYWORD_FLAG),
        ENTITY_FLAG,
        max_degree(F.col("_relations"), F.col("_nodes")).alias(MAX_DEGREE),
        total_edges(F.col("_relations")).alias(TOTAL_EDGES),
        TARGET,
    )


def detection_features(
    reports: DataFrame,
    terms: DataFrame,
    cfg: DetectionConfig = DetectionConfig(),
    entities: DataFrame | None = None,
    entity_flag: Column | None = None,
) -> DataFrame:
    """``(id, malware flag, keyword flag, entity flag, graph features, target)``.

    Reports are read once: a text is cleaned and split while it is in hand, both
    dictionaries are looked up in the same pass, and all else is computed beside
    it. Every row is judged by itself, also if its id is null or occurs twice.
    """
    wanted = terms_as_text(terms) if cfg.normalize_terms_as_text else terms
    sets = [TermSet(MALWARE_FLAG, wanted, cfg.text_col, cfg.whole_word, True, cfg.match_plan)]
    if entities is not None:
        names = entities.filter(F.col("type").isin(*cfg.entity_types)).select(F.col("name").alias("term"))
        sets.append(TermSet(ENTITY_FLAG, names, cfg.text_col, plan=cfg.match_plan))
    if cfg.relations_col in reports.columns:
        parsed = with_relations(reports, cfg.relations_col, "_relations")
    else:
        parsed = reports.withColumn("_relations", F.array().cast(PAIRS))
    staged = parsed.select(
        cfg.id_col,
        cfg.text_col,
        (F.lit(0) if entity_flag is None else entity_flag).alias("_entity"),
        "_relations",
        malware_ids(entity_array(reports, ("label", "id"))).alias("_nodes"),
        any_malware(F.transform(entity_array(reports, ("label",)), lambda e: e["label"])).alias("_target"),
    )
    carry = {
        KEYWORD_FLAG: contains_any(clean_text(F.col(cfg.text_col)), cfg.keywords),
        MAX_DEGREE: max_degree(F.col("_relations"), F.col("_nodes")),
        TOTAL_EDGES: total_edges(F.col("_relations")),
        TARGET: F.col("_target"),
    }
    if entities is None:
        carry[ENTITY_FLAG] = F.col("_entity")
    flagged = flag_sets(staged, sets, [cfg.id_col], carry)
    return flagged.select(
        cfg.id_col, MALWARE_FLAG, KEYWORD_FLAG, ENTITY_FLAG, MAX_DEGREE, TOTAL_EDGES, TARGET
    )


def text_features(with_entities: bool) -> list[str]:
    return [MALWARE_FLAG, KEYWORD_FLAG] + ([ENTITY_FLAG] if with_entities else [])


def graph_features(with_entities: bool) -> list[str]:
    return [*text_features(with_entities), MAX_DEGREE, TOTAL_EDGES]


def matrices(test: DataFrame, predictions: dict[str, Column], true_col: str = TARGET) -> DataFrame:
    """``(model, tn, fp, fn, tp)`` of several 0/1 predictions, in one pass over the rows."""
    t = F.col(true_col)
    per_model = F.array(
        *(F.struct(F.lit(name).alias("model"), p.cast("int").alias("p")) for name, p in predictions.items())
    )
    p = F.col("p")
    rows = test.select(true_col, F.inline(per_model))
    return rows.groupBy("model").agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


@dataclass(frozen=True)
class Comparison:
    """Fitted models (None where the training rows hold one class) and all matrices."""

    models: dict[str, LogisticFit | None]
    matrices: DataFrame

    def report(self) -> DataFrame:
        return report_of(self.matrices, CLASS_NAMES, ("model",))


def compare_detectors(
    split: DataFrame, cfg: DetectionConfig = DetectionConfig(), with_entities: bool = True
) -> Comparison:
    """Dictionary flag, text-flag model and graph model on the same test rows."""
    train = split.filter(~F.col("is_test"))
    test = split.filter(F.col("is_test"))
    wanted = {TEXT_MODEL: text_features(with_entities), GRAPH_MODEL: graph_features(with_entities)}
    models = {
        name: fit_logistic(train, features, TARGET, cfg.c, cfg.max_iter)
        for name, features in wanted.items()
    }
    predictions = {BASELINE: F.col(MALWARE_FLAG)}
    predictions |= {name: m.score() > 0 for name, m in models.items() if m is not None}
    return Comparison(models, matrices(test, predictions))


@dataclass(frozen=True)
class DetectionResult:
    features: DataFrame
    split: DataFrame
    terms: DataFrame
    comparison: Comparison
    graph_summary: DataFrame
    result: dict


def split_rows(labelled: DataFrame, cfg: DetectionConfig) -> DataFrame:
    """The stratified split of the settings, as ``is_test``."""
    order = None if cfg.split_order is None else F.expr(cfg.split_order)
    return stratified_split(labelled, cfg.id_col, TARGET, cfg.test_size, cfg.seed, order, cfg.split_order_bits)


def _train_rows(reports: DataFrame, cfg: DetectionConfig) -> DataFrame:
    """The rows that the split will train on: a filter, texts are not shuffled."""
    labelled = derive_label(reports.drop(TARGET), TARGET)
    split = split_rows(labelled, cfg)
    return split.filter(~F.col("is_test")).drop("is_test", TARGET)


def _dictionary(reports, cfg, terms, terms_path, answers) -> tuple[DataFrame, bool]:
    if terms is not None:
        return terms.select("term").distinct(), True

    def build() -> DataFrame:
        rows = _train_rows(reports, cfg) if cfg.dictionary_from == "train" else reports
        names = malware_names(rows, cfg.id_col, cfg.text_col)
        return build_terms(names, answers, cfg.min_term_length)

    if terms_path is None:
        return written(build(), "dictionary"), False
    return load_or_build_terms(reports.sparkSession, terms_path, build)


def _section(name, comparison, rows, lines, features) -> dict:
    head = {} if features is None else {"features_used": features}
    if name not in rows:
        return head | {"confusion_matrix": None, "classification_report_dict": {"error": "Skipped"}}
    m = rows[name]
    report = {}
    for line in lines[name]:
        if line["class"] == "accuracy":
            report["accuracy"] = line["precision"]
        else:
            report[line["class"]] = {
                "precision": line["precision"],
                "recall": line["recall"],
                "f1-score": line["f1"],
                "support": float(line["support"]),
            }
    grid = [[m["tn"], m["fp"]], [m["fn"], m["tp"]]]
    return head | {"confusion_matrix": grid, "classification_report_dict": report}


def run_detection(
    reports: DataFrame,
    cfg: DetectionConfig = DetectionConfig(),
    terms: DataFrame | None = None,
    terms_path: str | None = None,
    answers: DataFrame | None = None,
    entities: DataFrame | None = None,
    entity_flag: Column | None = None,
    source_name: str = "",
) -> DetectionResult:
    """Run all stages on wide reports.

    The dictionary is ``terms`` if given, else the one stored at ``terms_path``,
    else built from the reports (and ``answers(name, content)``). The entity flag
    comes from a gazetteer ``entities(name, type)`` or a recognizer column;
    without either it is 0 and no model uses it.
    """
    started = datetime.now(timezone.utc)
    reports = with_row_id(check_rows(reports, 2), cfg.id_col)
    width = group_width(reports.columns)
    terms, loaded = _dictionary(reports, cfg, terms, terms_path, answers)
    size = terms.count()
    if size == 0:
        raise ValueError("the dictionary is empty")

    with_entities = entities is not None or entity_flag is not None
    features = written(detection_features(reports, terms, cfg, entities, entity_flag), "features")
    graph_summary = numeric_summary(features, [MAX_DEGREE, TOTAL_EDGES])
    split = written(split_rows(features, cfg), "split")
    sizes = dict(split.groupBy("is_test").count().collect())  # two rows
    if not sizes.get(True):
        raise ValueError("the test set is empty")

    comparison = compare_detectors(split, cfg, with_entities)
    rows = {r["model"]: r for r in comparison.matrices.collect()}  # three rows
    lines: dict[str, list] = {}
    for line in comparison.report().collect():  # five lines a model
        lines.setdefault(line["model"], []).append(line)

    used = {BASELINE: None, TEXT_MODEL: text_features(with_entities), GRAPH_MODEL: graph_features(with_entities)}
    ended = datetime.now(timezone.utc)
    result = {
        "run_timestamp_start": started.isoformat(),
        "run_timestamp_end": ended.isoformat(),
        "duration_seconds": round((ended - started).total_seconds(), 2),
        "config": {
            "dataset": source_name,
            "test_set_size": cfg.test_size,
            "random_state": cfg.seed,
            "min_term_length": cfg.min_term_length,
            "dictionary_cache": terms_path,
            "aliases_given": answers is not None,
            "entity_recognizer_given": with_entities,
            "true_label_derivation": [f"label_{i}" for i in range(1, width + 1)],
        },
        "dataset_info": {
            "initial_rows": sum(sizes.values()),
            "train_rows": sizes.get(False, 0),
            "test_rows": sizes[True],
            "full_set_derived_label_dist": share_map(features, TARGET),
        },
        "dictionary_info": {"size": size, "loaded_from_cache": loaded},
    }
    for name, section in SECTIONS.items():
        result[section] = _section(name, comparison, rows, lines, used[name])
    return DetectionResult(features, split, terms, comparison, graph_summary, result)
