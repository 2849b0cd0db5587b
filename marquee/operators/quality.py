"""Column data tests as report tables (unique, not_null, relationships).

Each test returns rows ``(table_name, column_name, test, failures)``; a test
never fails the job, matching warn-only source tests.  :func:`run_tests` scans
every table once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared source tests, (table, column, test[, parent table, parent column]).
SOURCE_TESTS = (
    ("title_basics", "tconst", "unique"),
    ("title_basics", "tconst", "not_null"),
    ("title_basics", "titleType", "not_null"),
    ("title_ratings", "tconst", "not_null"),
    ("title_ratings", "tconst", "relationships", "title_basics", "tconst"),
    ("title_ratings", "averageRating", "not_null"),
    ("title_ratings", "numVotes", "not_null"),
    ("name_basics", "nconst", "unique"),
    ("name_basics", "nconst", "not_null"),
    ("name_basics", "primaryName", "not_null"),
    ("title_crew", "tconst", "not_null"),
    ("title_principals", "tconst", "not_null"),
    ("title_principals", "ordering", "not_null"),
    ("title_principals", "nconst", "not_null"),
)

REPORT_COLS = ("table_name", "column_name", "test", "failures")


def not_null_tests(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts of several columns in one pass, one report row per column."""
    return _as_rows(df, [((table, c, "not_null"), F.count_if(F.col(c).isNull())) for c in columns])


def _families(tests: Sequence[tuple]) -> list[list[tuple[str, str]]]:
    """(table, column) keys of unique and relationship tests, those linked by a relationship together."""
    family: dict[tuple[str, str], int] = {}
    for t in tests:
        keys = [t[:2]] if t[2] == "unique" else [t[:2], (t[3], t[4])] if t[2] == "relationships" else []
        for k in keys:
            family.setdefault(k, len(family))
        if len(keys) == 2 and family[keys[0]] != family[keys[1]]:
            old, new = family[keys[0]], family[keys[1]]
            family = {k: new if f == old else f for k, f in family.items()}
    out: dict[int, list] = {}
    for k, f in family.items():
        out.setdefault(f, []).append(k)
    return list(out.values())


def _keyed_pass(tables: Mapping[str, DataFrame], keys: list[tuple[str, str]], tests: Sequence[tuple],
                nulls: Mapping[str, Sequence[str]]) -> DataFrame:
    """Tests of tables that share a key: one scan of each, one grouping by the key.

    Every table's rows come in tagged; a key value then knows how often each
    table has it, and the NULLs of further columns are summed on the way.
    """
    flags = [(i, c) for i, (t, _) in enumerate(keys) for c in nulls.get(t, ())]
    parts = []
    for i, (t, column) in enumerate(keys):
        own = [F.col(c).isNull().cast("bigint") if j == i else F.lit(0).cast("bigint") for j, c in flags]
        parts.append(tables[t].select(F.col(column).cast("string").alias("k"), F.lit(i).alias("tag"),
                                      *[f.alias(f"f{n}") for n, f in enumerate(own)]))
    by_key = reduce(DataFrame.unionByName, parts).groupBy("k").agg(
        *[F.count_if(F.col("tag") == i).alias(f"n{i}") for i in range(len(keys))],
        *[F.sum(f"f{n}").alias(f"f{n}") for n in range(len(flags))])
    there = F.col("k").isNotNull()
    rows = []
    for t in tests:
        if t[2] == "unique" and t[:2] in keys:
            rows.append((t, F.count_if(there & (F.col(f"n{keys.index(t[:2])}") > 1))))
        elif t[2] == "relationships" and t[:2] in keys:
            child, parent = keys.index(t[:2]), keys.index((t[3], t[4]))
            rows.append((t, F.sum(F.when(there & (F.col(f"n{parent}") == 0), F.col(f"n{child}")))))
    rows += [((keys[i][0], c, "not_null"), F.sum(f"f{n}")) for n, (i, c) in enumerate(flags)]
    return _as_rows(by_key, rows)


def _as_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """One report row per (test, aggregate over ``df``)."""
    one = df.agg(*[F.coalesce(agg, F.lit(0)).cast("bigint").alias(f"r{i}") for i, (_, agg) in enumerate(rows)])
    report = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(t[:3], REPORT_COLS)], F.col(f"r{i}").alias("failures"))
                       for i, (t, _) in enumerate(rows)])
    return one.select(F.explode(report).alias("s")).select("s.*")


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[tuple] = SOURCE_TESTS) -> DataFrame:
    """All tests as one report DataFrame with a pass/warn status.

    Each table is scanned once: unique and relationship tests on a shared key
    are one grouping by it, which also sums the NULLs; a table without such a
    test takes one aggregate.
    """
    for t in tests:
        if t[2] not in ("unique", "not_null", "relationships"):
            raise ValueError(f"unknown test {t[2]!r}")
    nulls: dict[str, list[str]] = {}
    for t in tests:
        if t[2] == "not_null":
            nulls.setdefault(t[0], []).append(t[1])
    parts = []
    for keys in _families(tests):
        once = [t for t, _ in keys]
        # the NULLs of a table are summed in its first pass; not where it stands with two keys
        here = {t: nulls.pop(t) for t in dict(keys) if t in nulls and once.count(t) == 1}
        parts.append(_keyed_pass(tables, keys, tests, here))
    for table, cols in nulls.items():
        parts.append(not_null_tests(tables[table], table, cols))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("failures") > 0, "warn").otherwise("pass"))
