"""What the warehouse's build moves and writes: shuffles of its steps, and the same rows on odd input."""

import threading

import pytest
from pyspark.sql import functions as F

from marquee.operators.nest import nest_ordered
from marquee.operators.person_stats import career_stats, person_movie_rows
from marquee.plans.warehouse import Warehouse
from marquee.sources import bindings
from marquee.sources.tsv import normalize_na

LINES = [  # orderkey, partkey, linenumber, returnflag, linestatus
    (1, 5, 1, "R", "F"), (1, 5, 2, "N", "O"), (1, 19, 3, "A", "F"), (2, 5, None, "R", "F"), (2, 6, 4, None, "F"),
    (2, 6, 17, "N", None), (3, 6, -2, "R", "a:b"), (3, None, 1, "N", ""), (3, 6, 1, "", ":"), (4, 5, 1, "R", "F"),
    (4, 5, 1, "R", "F"), (9, 5, 1, "R", "F"), (None, 5, 1, "R", "F"), (5, 7, 1, "R", "F"), (5, 19, 2, None, None)]
ORDERS = [(1, 29), (2, 2), (2, 2), (3, 7), (4, 12345678), (5, None)]


@pytest.fixture()
def sf(spark, tmp_path):
    d = str(tmp_path / "sf")
    spark.createDataFrame(LINES, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string, "
                          "l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame(ORDERS, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(5,), (6,), (7,), (8,)], "p_partkey bigint").write.parquet(f"{d}/part.parquet")
    return d


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _exchanges(df):
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()      # not yet run: the first plan only
    return [line for line in plan.splitlines() if "Exchange " in line]


def _nm(k):
    return None if k is None else "nm" + str(k).rjust(7, "0")


def test_principals_of_odd_lines(spark, sf, no_broadcast):
    want = []
    for ok, pk, n, flag, status in LINES:
        for o, ck in ORDERS:
            if ok is None or o != ok:
                continue
            kind = ("producer" if flag == "R" or (pk is not None and pk % 19 == 0)
                    else ("actor" if status == "F" else "actress") if ck is not None and ck % 29 == 0
                    else "actor" if ck is not None and ck % 2 == 0 else "actress")
            want.append((None if pk is None else "tt" + str(pk).rjust(7, "0"), None if n is None else ok * 16 + n,
                         _nm(ck), kind, None, None if n is None or status is None else f'["{status}{n}"]'))
    df = bindings.title_principals(spark, sf)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    # the line's own values pass the join as one column
    assert [e for e in _exchanges(df) if "hashpartitioning(l_orderkey" in e]
    assert "l_linestatus" not in df._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]


def test_crew_by_one_shuffle_of_its_pairs(spark, sf, no_broadcast):
    df = bindings.title_crew(spark, sf)
    assert {tuple(r) for r in df.collect()} == {
        ("tt0000005", "nm0000002,nm0000029,nm12345678", "\\N"), ("tt0000006", "nm0000007", "\\N"),
        ("tt0000007", "", "\\N"), ("tt0000008", "\\N", "\\N")}
    # lines and orders by order, pairs and parts by part
    assert len(_exchanges(df)) == 4


def test_statistics_move_credits_once(spark, no_broadcast):
    person = "array<struct<id string, gender string>>"
    movies = spark.createDataFrame([
        ("m1", "A", 7.5, 100, 2000, [("p", "Male"), ("q", "Female"), ("p", "Female")]),
        ("m1", "A", 7.5, 100, 2000, [("p", "Male")]),                    # the id again
        ("m2", "B", 7.5, 100, 1990, [("p", "Male"), (None, "Male")]),
        (None, "C", 1.0, 1, 1980, [("q", None)]), ("m3", "D", 9.0, 5, 2010, [])],
        f"movie_id string, title string, average_rating double, num_votes bigint, release_year int, actors {person}")
    stats = career_stats(person_movie_rows(movies, "actors", 1, with_gender=True), lead=True, gender=True)
    got = {r.person_id: r for r in stats.collect()}
    assert set(got) == {"p", "q"}
    p, q = got["p"], got["q"]
    assert (p.total_movies, p.total_votes, p.avg_movie_rating, p.best_movie_id, p.best_movie_title) == (2, 400, 7.5, "m1", "A")
    assert (p.first_movie_year, p.latest_movie_year, p.best_movie_year, p.genders) == (1990, 2000, 2000, ["Female", "Male"])
    assert (q.total_movies, q.total_votes, q.best_movie_rating, q.lead_role_count, q.genders) == (1, 101, 7.5, 1, ["Female"])
    by_movie, by_person = _exchanges(stats)[::-1]
    assert "hashpartitioning(movie_id" in by_movie and "hashpartitioning(person_id" in by_person
    assert "REPARTITION" in by_movie       # arrays, before they are exploded


def test_sort_keys_in_the_struct_travel_once(spark):
    rows = spark.createDataFrame([("t", "b", "1", 5), ("t", "a", "2", None), ("t", "a", None, 7), ("u", None, "3", 1)],
                                 "g string, name string, id string, y int")
    plain = nest_ordered(rows, "g", ["name", "id"], [F.col("id").alias("i"), F.col("name").alias("n"), F.col("y")], "a")
    once = nest_ordered(rows, "g", ["name", "id"], [F.col("y")], "a", {"i": 1, "n": 0})
    assert once.schema["a"].dataType.simpleString() == plain.schema["a"].dataType.simpleString()
    assert {r.g: r.a for r in once.collect()} == {r.g: r.a for r in plain.collect()}


def test_tables_are_saved_together(spark, tmp_path):
    both, met = threading.Barrier(2, timeout=60), []

    class Tables(dict):
        def __getitem__(self, name):        # each waits until the other one is begun
            both.wait()
            met.append(name)
            return super().__getitem__(name)

    w = Warehouse(spark, str(tmp_path / "w"), "together_")
    try:
        w.load_bronze(Tables(a=spark.range(3), b=normalize_na(spark.range(5).select(F.col("id").cast("string")))))
        assert sorted(met) == ["a", "b"] and w.rows == {"a": 3, "b": 5} and list(w.rows) == ["a", "b"]
        assert w.table("b").count() == 5
        assert list((tmp_path / "w" / "a").glob("*.zstd.parquet"))
    finally:
        w.drop()
