"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the number of cores.  Every
result is computed whole and handed to the no-op sink, so neither the driver nor a
file system is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from termweave.plans.queries import QUERIES

HEADLINE = (
    "tfidf_inverted_index",
    "relative_term_frequency",
    "cycle_count_k2",
    "cycle_count_k3",
    "cycle_count_k4",
    "set_similarity_join",
    "term_frequency",
    "document_frequency",
    "cooccurrence_counts",
    "cooccurrence_totals",
    "simple_paths_k3",
    "cycles_k3",
    "canonical_token_order",
    "similarity_candidates",
)


def main(folder: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("termweave-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.checkpoint.dir", folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query, so that the first timing is not that of a cold JVM.
    QUERIES["document_frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory() as intermediates:
        main(intermediates)
