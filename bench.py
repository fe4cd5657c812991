"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
cores. Each time includes building the query, its model fits and writing its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lexloom.queries import QUERIES  # noqa: E402

HEADLINE = [
    "token_counts",
    "vocabulary",
    "tfidf_terms",
    "group_keywords_below",
    "group_keywords_top",
    "topics",
    "topics_by_lang",
    "max_pool",
    "nearest_k",
    "most_similar_labels",
    "word2vec_nearest",
    "drift_by_entity",
    "drift_overall",
    "cluster_members",
    "cluster_quality",
    "nb_metrics",
    "svm_metrics",
    "collect_by",
    "token_bag",
    "null_profile",
    "csv_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="lexloom-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.maxFields", "1000")
        .config("spark.checkpoint.dir", shared)
        # Each table is one row group, which one task would read.
        .config("spark.lexloom.scanPartitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and Python's machinery before the clock runs.
    for name in ("null_profile", "nearest_k"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
