"""Unnesting arrays of structs and predicates over them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array_col: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """``FROM t, UNNEST(t.arr) AS alias``: NULL and empty arrays yield no rows."""
    return df.select(*keep, F.explode(array_col).alias(alias))


def unnest_with_pos(df: DataFrame, array_col: str, alias: str, pos: str = "pos",
                    keep: Sequence[str] = ()) -> DataFrame:
    """``UNNEST(arr) AS alias WITH OFFSET AS pos`` (0-based)."""
    return df.select(*keep, F.posexplode(array_col).alias(pos, alias))


def unnest_fields(df: DataFrame, array_col: str, fields: Sequence[str],
                  keep: Sequence[str] = (), pos: str | None = None) -> DataFrame:
    """Unnest only some struct fields: ``arrays_zip(arr.f1, arr.f2)`` lets the
    Parquet reader prune the other fields of the nested column."""
    zipped = F.arrays_zip(*[F.col(f"{array_col}.{f}").alias(f) for f in fields])
    if pos is None:
        out = df.select(*keep, F.explode(zipped).alias("_e"))
    else:
        out = df.select(*keep, F.posexplode(zipped).alias(pos, "_e"))
    return out.select(*keep, *([pos] if pos else []), *[F.col(f"_e.{f}").alias(f) for f in fields])


def any_match(array_col: str, field: str, pred: Callable[[Column], Column]) -> Column:
    """``EXISTS (SELECT 1 FROM UNNEST(arr) a WHERE pred(a.field))`` as a
    higher-order ``exists`` over one field (no self-join, field-level pruning)."""
    return F.exists(F.col(f"{array_col}.{field}"), pred)
