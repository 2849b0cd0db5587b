"""Benchmark: median seconds per headline query, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=3 python bench.py

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  ``value`` is the sum of the per-query medians.  Marts and questions
read the written tables, which the warm-up builds; ``build_marts`` times that
build itself, from the raw tables.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_marts", "stg_actor", "stg_crew", "movies_flat", "movies_actors", "dim_directors", "dim_actors",
    "q_top_rated", "q_movies_by_director_like", "q_actors_with_director", "q_collaboration",
    "q_directors_most_movies", "q_gender_by_decade", "q_sql_surface", "dq_report",
    "usage_summary", "usage_session_duration",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from marquee.catalog import QUERIES
    from marquee.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="marquee-bench",
                          shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = only or HEADLINE
    # warm up the JVM and the Python workers once
    QUERIES["movies_flat"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    per_query = {}
    for name in names:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        per_query[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "median_query_seconds_sum", "value": round(sum(per_query.values()), 3),
           "unit": "sec", "queries": per_query, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": cpus, "runs": runs}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
