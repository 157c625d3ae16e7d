"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores, BENCH_RUNS
how often each query runs (the best run counts, so that compiling the first
time does not).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import queries  # noqa: E402

HEADLINE = (
    "clean_text",
    "dictionary_match",
    "dictionary_match_words",
    "keyword_match",
    "entity_gazetteer_flag",
    "dictionary_build",
    "relations_parse",
    "graph_features_rows",
    "graph_features_edges",
    "derive_label",
    "numeric_summary",
    "stratified_split",
    "classification_report",
    "detection_features",
    "three_way_report",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexvane-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("value_shares")  # start-up of the session is not part of any query
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {name: round(min(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
