"""Plan shapes that matter at scale."""

import os

from conftest import SF001
from pyspark.sql import functions as F

from marquee.operators.unnest import unnest_fields
from marquee.plans import marts, questions
from marquee.plans.pipeline import models_from_fixtures


def _plan(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_topk_uses_window_group_limit(spark):
    m = models_from_fixtures(spark, SF001)
    p = _plan(marts.actors_agg(m.stg_actor))
    assert "WindowGroupLimit" in p


def test_nested_predicates_prune_and_do_not_self_join(spark, tmp_out):
    m = models_from_fixtures(spark, SF001)
    path = os.path.join(tmp_out, "movies")
    m.movies.write.parquet(path)
    mv = spark.read.parquet(path)
    q = questions.movies_by_director_like(mv, "%0001%")
    p = _plan(q)
    assert "Join" not in p
    assert "directors:array<struct<name:string>>" in p
    assert "actors" not in p.split("ReadSchema:")[1]
    z = unnest_fields(mv, "actors", ["id", "gender"], keep=["movie_id"])
    assert "actors:array<struct<id:string,gender:string>>" in _plan(z)


def test_filters_reach_the_scan(spark, tmp_out):
    p = os.path.join(tmp_out, "r")
    spark.range(100).select(F.col("id").alias("num_votes"),
                            (F.col("id") / 10).alias("average_rating")).write.parquet(p)
    q = spark.read.parquet(p).filter("num_votes > 50").select("average_rating")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(num_votes), GreaterThan(num_votes,50)]" in plan
    assert "ReadSchema: struct<num_votes:bigint,average_rating:double>" in plan


def test_flat_questions_drop_people_joins(spark):
    m = models_from_fixtures(spark, SF001)
    p = m.movies.select("movie_id", "average_rating")._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in p  # the people arrays (and their inputs) are pruned


def test_topk_partial_limit_survives_sort_merge_plans(spark):
    """With broadcasts off (large inputs), the semi join must not hand the
    top-k an input already partitioned by title, or the partial limit before
    the title shuffle disappears and a hot title reaches one task whole."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        m = models_from_fixtures(spark, SF001)
        df = marts.movies_actors(m.movies)
        df.collect()
        p = _plan(df).split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in p
        assert p.count("WindowGroupLimit") == 2          # partial + final
        assert ", Partial" in p and ", Final" in p
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_person_stats_aggregate_partially_before_the_shuffle(spark):
    from marquee.operators.person_stats import career_stats, person_movie_rows
    m = models_from_fixtures(spark, SF001)
    stats = career_stats(person_movie_rows(m.movies, "actors", 1, with_gender=True),
                         lead=True, gender=True)
    p = _plan(stats)
    exch = p.index("Exchange hashpartitioning(person_id")
    assert "partial_" in p[exch:]            # map-side partial aggregate below the exchange
    assert "Generate posexplode" in p[exch:]  # credit rows come from the array, no shuffle
