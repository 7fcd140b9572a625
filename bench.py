"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each query runs to completion into Spark's ``noop``
sink (whole plan executed, nothing collected); the figure per query is the
median wall time over the runs after one warm-up pass of the whole set.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from clickfeat.session import local_session  # noqa: E402
from clickfeat.plans import queries as Q  # noqa: E402

HEADLINE = [
    "silver_events",
    "session_metrics",
    "product_session_metrics",
    "user_metrics",
    "product_metrics",
    "user_product_metrics",
    "session_product_outcomes",
    "raw_features",
    "features_and_labels",
    "split_train",
    "average_precision",
    "train_and_score",
    "raw_features_and_labels",
    "class_metrics",
    "session_metrics_skewed",
    "stream_ingest",
    "tuning_trials",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="clickfeat-bench")
    catalogue = Q.catalogue()
    names = [n for n in HEADLINE if n in catalogue]
    for n in names:  # warm-up: JIT, file listing caches
        run_once(spark, catalogue[n], sf_dir)
    timings = {n: statistics.median(run_once(spark, catalogue[n], sf_dir) for _ in range(runs))
               for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {n: round(t, 3) for n, t in timings.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
