"""Ordered array aggregation: ``ARRAY_AGG(STRUCT(...) ORDER BY ... [LIMIT k])``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nest_ordered(df: DataFrame, group: str, order: Sequence, fields: Sequence[Column],
                 name: str, from_order: Mapping[str, int] | None = None) -> DataFrame:
    """One row per ``group`` with an array of ``struct(fields)`` sorted by ``order``.

    The sort keys ride in front of the payload so ``array_sort`` orders the
    elements; ``transform`` then strips them.  Ascending, NULL keys first.
    ``from_order``: fields that are sort keys (name -> place in ``order``); they
    travel once and come first in the struct.
    """
    keys = [_col(c).alias(f"_k{i}") for i, c in enumerate(order)]
    if from_order:
        rest = df.select(*fields).columns
        flat = F.struct(*keys, *fields)
        return (df.groupBy(group)
                  .agg(F.array_sort(F.collect_list(flat)).alias("_a"))
                  .select(group, F.transform("_a", lambda e: F.struct(
                      *[e[f"_k{i}"].alias(n) for n, i in from_order.items()],
                      *[e[n].alias(n) for n in rest])).alias(name)))
    packed = F.struct(*keys, F.struct(*fields).alias("_v"))
    return (df.groupBy(group)
              .agg(F.array_sort(F.collect_list(packed)).alias("_a"))
              .select(group, F.transform("_a", lambda e: e["_v"]).alias(name)))


def nest_in_runs(df: DataFrame, group: str, order: Sequence, fields: Sequence[Column],
                 name: str, run_rows: int = 100_000) -> DataFrame:
    """Same rows as :func:`nest_ordered`; a group above ``run_rows`` rows is built from sorted runs.

    Rows of large groups are range-partitioned by (group, order) and sorted, so
    that a large group lies in consecutive partitions.  Within a partition
    every ``run_rows`` consecutive places are one run, collected apart; a group's
    runs are then put in order by number and joined end to end.  No task
    sorts or buffers a large group's rows as objects: it holds packed runs
    of at most ``run_rows`` rows, and the finished array, which is one row of
    the result.  Groups up to ``run_rows`` take the plain way.  The order must
    be total within a group, as ties have no defined place.
    """
    keys = [_col(c).alias(f"_k{i}") for i, c in enumerate(order)]
    rows = df.select(_col(group).alias(group), *keys, F.struct(*fields).alias("_v"))
    ks = [f"_k{i}" for i in range(len(keys))]
    large = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > run_rows).select(group)
    small = nest_ordered(rows.join(large, group, "left_anti"), group, ks, [F.col("_v")], name) \
        .select(group, F.transform(name, lambda e: e["_v"]).alias(name))
    spread = rows.join(large, group, "left_semi").repartitionByRange(group, *ks).sortWithinPartitions(group, *ks)
    # partition number in the upper bits, place within the partition in the lower 33
    placed = spread.withColumn("_at", F.monotonically_increasing_id())
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    run = F.struct(F.shiftright("_at", 33).alias("p"), F.floor(place / run_rows).alias("r"))
    runs = placed.groupBy(group, run.alias("_run")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_v"))).alias("_a"))
    joined = (runs.select(group, F.struct("_run", F.transform("_a", lambda e: e["_v"]).alias("v")).alias("_r"))
              .groupBy(group).agg(F.collect_list("_r").alias("_rs")))
    # few runs a group: only their numbers are compared
    ordered = F.array_sort("_rs", lambda a, b: F.when(a["_run"] < b["_run"], -1).otherwise(1))
    return small.unionByName(joined.select(
        group, F.flatten(F.transform(ordered, lambda r: r["v"])).alias(name)))


def nest_topk(df: DataFrame, group: str, order: Sequence, fields: Sequence[Column],
              k: int, name: str) -> DataFrame:
    """Like :func:`nest_ordered` but keeps the first ``k`` rows of each group.

    ``row_number() <= k`` plans as a partial WindowGroupLimit before the
    shuffle, so a group never ships more than ``k`` rows per map task: a
    title with millions of credits stays cheap.
    """
    w = Window.partitionBy(group).orderBy(*[_col(c) for c in order])
    top = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return nest_ordered(top, group, ["_rn"], fields, name)
