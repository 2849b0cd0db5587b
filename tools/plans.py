"""Summarise the executed (final adaptive) physical plan of each query key.

    python tools/plans.py [sf_dir] [key ...] > PLANS.md

Counts shuffles by partitioning, joins by strategy, aggregates by kind, and
flags WindowGroupLimit / checkpoint scans.  Broadcast choices depend on the
data size (AQE measures it), so at large scale the same plans show
sort-merge joins where small fixtures show broadcasts.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "reused": r"Reused(Exchange|QueryStage)",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "hash agg": r"(?<!Object)HashAggregate",
    "object agg": r"ObjectHashAggregate",
    "sort agg": r"SortAggregate",
    "group limit": r"WindowGroupLimit",
    "window": r"(?<!Group)Window \[",
    "checkpoint scan": r"Scan ExistingRDD",
    "parquet scans": r"FileScan parquet",
}


def summarise(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    return {k: len(re.findall(p, final)) for k, p in PATTERNS.items()}


def main() -> None:
    args = sys.argv[1:]
    large = "--large" in args
    args = [a for a in args if a != "--large"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = args[1:]
    from marquee.catalog import QUERIES
    from marquee.session import build_session
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if large else {}
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    cols = list(PATTERNS)
    mode = "automatic broadcasts off (large-input plans)" if large else "default thresholds"
    print(f"## Executed plans at {sf} (local[8], AQE on, {mode})\n")
    print("| key | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for key, fn in QUERIES.items():
        if only and key not in only:
            continue
        df = fn(spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {key} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
