"""Time the headline queries: one JSON line on stdout.

Each query is run to completion into a sink that discards its rows; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from verdex.bindings.queries import QUERIES

HEADLINE = (
    "merge_pages", "catalogue", "extract_text", "fold_pages", "clean_text", "normalise_tokens",
    "search_any", "term_match", "paragraphs", "term_paragraphs", "stem_vocab", "ngrams",
    "tfidf_top_terms", "tfidf_terms", "scale_features", "missing_files", "duplicate_stats",
    "duplicate_rows", "value_counts", "crosstab_top", "report_year", "report_class_pct",
    "report_compare", "stratified_split", "fold_table", "fold_metrics", "friedman_stat",
    "nemenyi_q", "clf_logistic", "clf_knn", "score_base",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
