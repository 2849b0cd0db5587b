"""Invariants on the fixture tables (sf0.001)."""

import pytest
from conftest import SF001
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.plans import marts
from marquee.plans.pipeline import models_from_fixtures


@pytest.fixture(scope="module")
def m(spark):
    return models_from_fixtures(spark, SF001)


def test_actor_arrays_capped_and_in_billing_order(m):
    mv = m.movies
    assert mv.filter(F.col("actor_count") > 10).count() == 0
    # independent numbering: named credits of surviving titles by billing order
    w = Window.partitionBy("movie_id").orderBy("ordering", "actor_id", "characters")
    want = (m.stg_actor.filter("actor_name is not null").join(m.movie_ids, "movie_id")
            .withColumn("pos", F.row_number().over(w) - 1).filter("pos < 10")
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"), "actor_id"))
    got = marts.movies_actors(mv).select("movie_id", "pos", "actor_id")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_unnest_of_nest_is_identity_below_the_cap(m):
    named = m.stg_actor.filter("actor_name is not null")
    small = named.groupBy("movie_id").count().filter("count <= 10").select("movie_id")
    want = named.join(small, "movie_id").join(m.movie_ids, "movie_id").select("movie_id", "actor_id")
    got = marts.movies_actors(m.movies).join(small, "movie_id").select("movie_id", "actor_id")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_dimension_totals_equal_recounts(m):
    recount = (marts.movies_directors(m.movies).groupBy("director_id")
               .agg(F.countDistinct("movie_id").alias("n")))
    d = m.dim_directors.select("director_id", "total_movies")
    assert d.join(recount, "director_id").filter("n != total_movies").count() == 0
    assert d.count() == recount.count()
    a = m.dim_actors.select("actor_id", "total_movies").distinct()
    arec = (marts.movies_actors(m.movies).groupBy("actor_id")
            .agg(F.countDistinct("movie_id").alias("n")))
    assert a.join(arec, "actor_id").filter("n != total_movies").count() == 0
    assert a.select("actor_id").distinct().count() == arec.count()


def test_null_arrays_have_null_counts(m):
    mv = m.movies
    assert mv.filter("directors is null and director_count is not null").count() == 0
    assert mv.filter("actors is not null and actor_count is null").count() == 0
