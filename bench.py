"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line. Each query runs once to warm
up and then $BENCH_RUNS times; its figure is the median."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from docframe.plans import package_queries, source_queries  # noqa: F401  each registers its queries
from docframe.plans.registry import QUERIES

HEADLINE = (
    "fold_text", "lines_as_blocks", "heading_flag", "theory_bounds", "section_tree", "section_paths", "bullet_runs", "run_merge", "question_segments", "choice_split", "odd_color",
    "asset_registry", "doc_stats", "qa_gates", "groundtruth_eval", "strip_html", "upsert_anti",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": "4m",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
