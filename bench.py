"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Every query is executed in
full through the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "training_pairs", "body_pairs", "record_pairs", "threads", "summary_totals",
    "count_field_values", "vocab", "encode", "tfidf", "take_while", "drop_n",
    "preprocess_full", "clean_labelled",
]


def main() -> None:
    from skein.plans.catalog import QUERIES
    from skein.session import clear_scratch, get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="skein-bench", shuffle_partitions=cpus * 2,
                      **{"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    # warm the JVM (JIT of regex, aggregation and join code) on the smallest
    # data set, untimed, so the timings below are steady-state
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
