"""Joins in which one key may hold a large share of the rows.

Adaptive execution splits a large sort-merge partition by map output, once
it is there.  Salting keeps it from coming about: the rows of the few hot
keys are spread by a hash over ``salts`` parts, and only these keys' rows of
the other side are repeated.  Which keys are hot changes the plan's balance,
never its result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.02, tracked: int = 4096) -> list:
    """Keys that hold more than ``share`` of the rows (at most ``1 / share`` of them).

    One pass with a frequent-items sketch, merged from partial sketches, so
    nothing is shuffled by key; the driver sees ``ceil(1 / share)`` counters.
    The sketch errs by about ``3.5 / tracked`` of the rows.  NULL is never a
    hot key: it meets nothing in an equi-join.
    """
    most = int(-(-1 // share))
    top = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    return [t["item"] for t in top["top"] or [] if t["count"] > share * top["n"]]


def salted_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     hot: Sequence, spread: Sequence[str], salts: int = 16) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, hot keys spread over ``salts`` parts.

    ``spread``: columns of ``left`` that differ between a hot key's rows; their
    hash is the salt, so that a task run again makes the same rows.  NULL
    keys meet nothing and are spread too.  Columns are those of ``left``, then
    of ``right``; the two must not share names.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    part = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    is_hot = F.col(left_key).isin(*hot) if hot else F.lit(False)
    lsalt = F.when(is_hot | F.col(left_key).isNull(), part).otherwise(0)
    parts = F.when(F.col(right_key).isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))) if hot else F.lit(None)
    salted = right.select("*", F.explode(F.coalesce(parts, F.array(F.lit(0)))).alias("_right_salt"))
    return (left.withColumn("_left_salt", lsalt)
                .join(salted, (F.col(left_key) == F.col(right_key))
                      & (F.col("_left_salt") == F.col("_right_salt")), "left")
                .drop("_left_salt", "_right_salt"))
