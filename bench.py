"""Time the headline queries: one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every result is computed in full
and discarded; the first query runs once beforehand, so that the session's start is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "review_funnel",
    "clean_reviews",
    "class_distribution",
    "word_counts",
    "top_words",
    "keywords_top",
    "document_keywords",
    "tfidf_long",
    "vocab_tfidf_long",
    "hash_split",
    "stratified_split",
    "confusion_matrix",
    "classification_report",
    "weighted_metrics",
    "fit_hashing_metrics",
    "fit_vocab_metrics",
    "score_requests",
    "score_stream",
    "csv_roundtrip",
    "documents_roundtrip",
    "full_analysis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sentiflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(HEADLINE[0])
    seconds = {name: run(name) for name in HEADLINE}
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
