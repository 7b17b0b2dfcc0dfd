"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Small results are collected; row-level ones go to the ``noop`` sink, which
computes every column of every row (a count would prune them away).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from canopy.plans.queries import QUERIES  # noqa: E402
from canopy.session import local_session  # noqa: E402

HEADLINE = (
    "cells",
    "quartile_cuts",
    "attr_value_counts",
    "info_gain",
    "id3_tree",
    "id3_tree_lineitem",
    "predict",
    "mean_squared_error_lineitem",
    "row_index",
)
ROW_LEVEL = {"predict", "row_index"}


def compute(name, df):
    if name in ROW_LEVEL:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(
        cpus,
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
        app="canopy-bench",
        event_log_dir=os.environ.get("BENCH_EVENT_LOG_DIR"),
    )
    # warm-up (JVM start, JIT, codegen caches): the same queries on the
    # smallest provided scale factor next to the measured one, if present
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(sf_dir):
        for name in names:
            compute(name, QUERIES[name](spark, small))
    else:
        QUERIES["row_count"](spark, sf_dir).collect()
    timings, jobs = {}, {}
    sc = spark.sparkContext
    for name in names:
        sc.setJobGroup(f"bench-{name}", name)
        t0 = time.perf_counter()
        compute(name, QUERIES[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"bench-{name}"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "spark_jobs": jobs,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
