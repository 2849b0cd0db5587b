from conftest import SF001, bronze_df
from helpers import person

from marquee.operators import quality
from marquee.sources.bindings import bronze_tables


def test_tests_on_hand_rows(spark):
    people = bronze_df(spark, "name_basics", [person("nm1"), person("nm1"), person("nm2"),
                                              (None, None, "1960", "\\N", "x", "tt1"),
                                              (None, "A", "1960", "\\N", "x", "tt1")])
    titles = spark.createDataFrame([("tt1",), ("tt2",), ("tt2",), ("tt2",), (None,), (None,)], "tconst string")
    ratings = spark.createDataFrame([("tt1", 1), ("tt3", None), ("tt3", 2), (None, None)], "tconst string, v int")
    tests = [("p", "nconst", "unique"), ("p", "nconst", "not_null"), ("p", "primaryName", "not_null"),
             ("t", "tconst", "unique"), ("t", "tconst", "not_null"), ("r", "v", "not_null"), ("r", "tconst", "not_null"),
             ("r", "tconst", "relationships", "t", "tconst"), ("e", "x", "not_null"), ("e", "x", "unique")]
    empty = spark.createDataFrame([], "x long")
    got = {tuple(r)[:3]: (r.failures, r.status)
           for r in quality.run_tests({"p": people, "t": titles, "r": ratings, "e": empty}, tests).collect()}
    assert {k: n for k, (n, _) in got.items()} == {
        ("p", "nconst", "unique"): 1, ("p", "nconst", "not_null"): 2, ("p", "primaryName", "not_null"): 1,
        ("t", "tconst", "unique"): 1, ("t", "tconst", "not_null"): 2, ("r", "v", "not_null"): 2,
        ("r", "tconst", "not_null"): 1, ("r", "tconst", "relationships"): 2, ("e", "x", "not_null"): 0,
        ("e", "x", "unique"): 0}
    assert all((s == "warn") == (n > 0) for n, s in got.values())


def test_two_keys_of_one_table_and_unknown_tests(spark):
    import pytest
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 9), (3, 2)], "id long, parent long")
    tests = [("n", "id", "unique"), ("n", "parent", "relationships", "n", "id"), ("n", "parent", "not_null")]
    got = {r.test: r.failures for r in quality.run_tests({"n": nodes}, tests).collect()}
    assert got == {"unique": 1, "relationships": 1, "not_null": 1}
    with pytest.raises(ValueError, match="unknown test"):
        quality.run_tests({"n": nodes}, [("n", "id", "accepted_values")])


def test_report_scans_every_table_once(spark):
    import re
    from marquee.catalog import warehouse
    w = warehouse(spark, SF001)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = quality.run_tests({n: w.table(n) for n in ("title_basics", "title_ratings", "name_basics",
                                                           "title_crew", "title_principals")})
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = plan.split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan", plan)) == 5
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2     # by title id, by person id
    assert "partial_" in plan and "Join" not in plan


def test_report_on_fixtures(spark):
    rep = quality.run_tests(bronze_tables(spark, SF001))
    rows = rep.collect()
    assert len(rows) == 14
    kinds = sorted(r.test for r in rows)
    assert kinds.count("unique") == 2 and kinds.count("not_null") == 11
    assert kinds.count("relationships") == 1
    assert all(r.status == ("warn" if r.failures else "pass") for r in rows)
