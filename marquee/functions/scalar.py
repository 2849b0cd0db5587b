"""Scalar column expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(x) -> Column:
    """String -> BIGINT, NULL when the text is not an integer (never raises)."""
    return _c(x).try_cast("bigint")


def trim_ws(x) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines too)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def _sql_string(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_tokens(x: str, tokens: Iterable[str]) -> Column:
    """Map any of ``tokens`` to NULL in string column ``x``, keep other values.

    Written as one SQL expression so that a long token list costs one
    round trip to the JVM per column instead of one per literal.
    """
    tokens = list(tokens)
    if not tokens:
        return F.col(x)
    name = "`" + x.replace("`", "``") + "`"
    in_list = ", ".join(_sql_string(t) for t in tokens)
    return F.expr(f"CASE WHEN {name} IN ({in_list}) THEN CAST(NULL AS STRING) ELSE {name} END")


def decode_gender(category) -> Column:
    c = _c(category)
    return (F.when(c == "actor", "Male")
             .when(c == "actress", "Female")
             .otherwise(F.lit(None).cast("string")))


def band(x, ladder: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """``CASE WHEN x >= b1 THEN l1 WHEN x >= b2 ... ELSE otherwise``.

    NULL input falls through to ``otherwise`` like a SQL CASE.
    """
    c = _c(x)
    expr = None
    for bound, label in ladder:
        expr = F.when(c >= bound, label) if expr is None else expr.when(c >= bound, label)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)


# The five band ladders of the marts (bound, label), highest first,
# followed by the label used below the last bound.
RATING_CATEGORY = ([(8.5, "Excellent"), (7.5, "Very Good"), (6.5, "Good"),
                    (5.5, "Average")], "Below Average")
PERSON_TIER = ([(8.0, "Elite"), (7.0, "Excellent"), (6.0, "Good")], "Average")
ACTOR_STAGE = ([(30, "Prolific"), (15, "Established"), (5, "Emerging")], "New")
DIRECTOR_STAGE = ([(20, "Prolific"), (10, "Established"), (5, "Emerging")], "New")
ROLE_TYPE = ([(50, "Leading Actor"), (25, "Mixed Roles")], "Supporting Actor")


def age(birth_year, death_year, as_of=None) -> Column:
    """Age at death, or at the year of ``as_of`` (a date string) when alive."""
    ref_year = F.year(F.current_date()) if as_of is None else F.year(F.lit(as_of).cast("date"))
    b, d = _c(birth_year), _c(death_year)
    return F.when(d.isNotNull(), d - b).otherwise(ref_year.cast("bigint") - b)


def decade(year) -> Column:
    """Start year of the decade, e.g. 1994 -> 1990 (NULL stays NULL)."""
    y = _c(year)
    return (F.floor(y / 10) * 10).cast("bigint")


def csv_contains(csv, value: str) -> Column:
    """Membership of ``value`` in a comma-separated list column."""
    return F.array_contains(F.split(_c(csv), ","), value)


def token_estimate(text) -> Column:
    """Rough token count: characters // 4."""
    from marquee.functions.numeric import int_div

    return int_div(F.length(_c(text)).cast("bigint"), F.lit(4))


def human_count(n) -> Column:
    """Integer count for display: >1e6 -> 'x.xxM', >1e3 -> 'x.xK', else as is.

    The digits are those of the quotient as a binary double, rounded to even
    at an exact half, as number formatting in most languages prints them:
    1250 -> 1.2K (1.25 is exact), 1450 -> 1.4K (1.45 lies below the half).
    The quotient is at least 1, so its fraction is a whole multiple of 2**-52
    and all arithmetic after the division is exact on integers.
    """
    from marquee.functions.numeric import int_div

    n = _c(n).cast("bigint")
    one = F.lit(1 << 52)

    def fixed(unit: int, digits: int) -> Column:
        scale = 10 ** digits
        d = n.cast("double") / F.lit(float(unit))
        whole = F.floor(d)
        scaled = ((d - whole.cast("double")) * F.lit(float(1 << 52))).cast("bigint") * F.lit(scale)
        q, left = int_div(scaled, one), F.pmod(scaled, one)
        half = F.lit(1 << 51)
        up = (left > half) | ((left == half) & (F.pmod(q, F.lit(2)) == 1))
        total = whole * F.lit(scale) + q + F.when(up, 1).otherwise(0)
        return F.concat(int_div(total, F.lit(scale)).cast("string"), F.lit("."),
                        F.lpad(F.pmod(total, F.lit(scale)).cast("string"), digits, "0"))

    return (F.when(n > 1_000_000, F.concat(fixed(1_000_000, 2), F.lit("M")))
             .when(n > 1_000, F.concat(fixed(1_000, 1), F.lit("K")))
             .otherwise(n.cast("string")))
