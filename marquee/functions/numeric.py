"""Exact rounding helpers.

``ROUND(AVG(x), 2)`` on doubles depends on the engine's float path; the marts
round half away from zero on the exact decimal value instead.  Ratings carry
one decimal, so a decimal(20,8) sum is exact and the rounding below is exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_TYPE = "decimal(20,8)"


def int_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exact (no float path)."""
    exact_multiple = (a - F.pmod(a, b)).cast("decimal(38,0)")
    return (exact_multiple / b.cast("decimal(38,0)")).cast("bigint")


def exact_mean(weighted_sum: Column, weight: Column, digits: int = 2) -> Column:
    """round(weighted_sum / weight, digits) half-up, as DOUBLE.

    ``weighted_sum`` is a decimal sum (see ``MEAN_TYPE``).
    """
    # decimal(28,8) / decimal(10,0) keeps 18 fractional digits in Spark's
    # precision rules, so the half-up step below sees the exact quotient.
    q = weighted_sum.cast("decimal(28,8)") / weight.cast("decimal(10,0)")
    return F.round(q, digits).cast("double")


def rounded_share(part: Column, whole: Column) -> Column:
    """round(100 * part / whole, 1) half-up: ((2000 p + w) div 2w) / 10."""
    p, w = part.cast("bigint"), whole.cast("bigint")
    return int_div(F.lit(2000) * p + w, F.lit(2) * w) / F.lit(10.0)
