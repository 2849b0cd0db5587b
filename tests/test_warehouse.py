"""The models as catalog tables: plans over the written base and marts, attach, ad-hoc SQL."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from marquee import catalog
from marquee.plans import questions
from marquee.plans.pipeline import models_from_fixtures
from marquee.plans.warehouse import MARTS, Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return catalog.warehouse(spark, SF001)


def _plan(df):
    return df._jdf.queryExecution().toString()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _without_broadcasts(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _physical(make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_written_marts_equal_the_lazy_models(spark, wh):
    m = models_from_fixtures(spark, SF001)
    for name, lazy in (("movies", m.movies), ("dim_directors", m.dim_directors), ("dim_actors", m.dim_actors)):
        written = wh.table(name).select(*lazy.columns)
        assert written.exceptAll(lazy).isEmpty() and lazy.exceptAll(written).isEmpty(), name
        assert wh.rows[name] == lazy.count()


def test_fact_joins_titles_and_ratings_once(spark, wh):
    lazy = _without_broadcasts(spark, lambda: models_from_fixtures(spark, SF001).movies)
    fact = _without_broadcasts(spark, wh.fact)
    assert 2 * len(re.findall(r"\bExchange ", fact)) <= len(re.findall(r"\bExchange ", lazy))
    assert "averageRating" not in fact and "titleType" not in fact     # the base stands for both
    # the base is not moved for the joins with the people arrays
    base = re.search(r"FileScan parquet [^\n]*base\[[^\n]*runtime_minutes[^\n]*", fact)
    assert base and "Bucketed: true" in base.group(0)


def test_credits_of_a_hot_title_can_still_be_split(spark, wh):
    fact = _without_broadcasts(spark, wh.fact)
    semi = fact[fact.index("LeftSemi"):]
    assert semi.index("Exchange hashpartitioning") < semi.index("FileScan")
    assert "WindowGroupLimit" in fact and "Partial" in fact


QUESTIONS = [k for k in catalog.QUERIES if k.startswith("q_")]


@pytest.mark.parametrize("key", QUESTIONS)
def test_questions_read_written_marts_only(spark, wh, key):
    plan = _without_broadcasts(spark, lambda: catalog.QUERIES[key](spark, SF001))
    scans = set(re.findall(r"FileScan parquet spark_catalog\.default\.(\w+)", plan))
    assert scans and scans <= {f"{wh.prefix}{n}".lower() for n in MARTS}
    assert SF001 not in plan
    assert len(re.findall(r"\bExchange ", plan)) <= 4


def test_decade_question_prunes_partitions(spark, wh):
    plan = _physical(catalog.QUERIES["q_best_of_decade"](spark, SF001))
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "release_decade" in pruned


def test_dimension_joins_use_the_buckets(spark, wh):
    movies, dims = wh.table("movies"), wh.table("dim_directors")
    credits = movies.select("movie_id", F.explode("directors.id").alias("director_id"))
    plan = _without_broadcasts(spark, lambda: credits.join(dims, "director_id"))
    assert len(re.findall(r"\bExchange ", plan)) == 1      # the credits only


def test_attach_keeps_buckets_partitions_and_rows(spark, wh):
    again = Warehouse(spark, wh.root, f"{wh.prefix}t_").attach()
    try:
        assert again.rows == wh.rows
        assert wh.table("movies").exceptAll(again.table("movies")).isEmpty()
        spec = dict((r.col_name, r.data_type) for r in spark.sql(
            f"DESCRIBE EXTENDED {again.prefix}dim_actors").collect())
        assert spec["Num Buckets"] == str(wh.buckets)
        assert again.table("movies").count() == wh.rows["movies"]
    finally:
        again.drop()
    assert not spark.catalog.tableExists(f"{again.prefix}movies") and wh.table("movies").count()


def test_adhoc_sql_takes_values_and_leaves_session_views_alone(spark, wh):
    spark.range(3).createOrReplaceTempView("movies")
    marts = {n: wh.table(n) for n in MARTS}
    name = "O'Neil\" OR 1=1 --"
    assert questions.sql_surface(spark, marts, questions.SQL_BY_ACTOR, {"name": name}).count() == 0
    assert spark.table("movies").columns == ["id"]
    got = questions.sql_surface(spark, marts, "SELECT count(*) AS n FROM {movies}").first().n
    assert got == wh.rows["movies"]
    spark.catalog.dropTempView("movies")


def test_unnest_function_is_the_array_in_order(spark, wh):
    marts = {n: wh.table(n) for n in MARTS}
    got = questions.sql_surface(spark, marts, "SELECT m.movie_id, p.pos, p.id FROM {movies} m, "
                                "LATERAL {unnest_directors}(m.directors) p")
    want = marts["movies"].select("movie_id", F.posexplode("directors").alias("pos", "d")).selectExpr(
        "movie_id", "cast(pos as bigint) as pos", "d.id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_changed_inputs_build_a_new_warehouse(spark, wh, tmp_path):
    import shutil
    d = tmp_path / "sf"
    shutil.copytree(SF001, d)
    a = catalog.warehouse(spark, str(d))
    assert catalog.warehouse(spark, str(d)) is a
    spark.read.parquet(f"{SF001}/part.parquet").filter("p_partkey % 2 = 0").toPandas().to_parquet(d / "part.parquet")
    b = catalog.warehouse(spark, str(d))
    assert b is not a and b.rows["title_basics"] < a.rows["title_basics"]
