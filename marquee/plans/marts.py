"""Marts: the nested ``movies`` fact and the two person dimensions.

Plan shape of ``movies`` (all joins on ``movie_id``):

    titles ⋈ ratings                       -> base (one row per surviving movie)
    credits ⋉ base -> ⋈ person -> top-k    -> actors array   (hash(movie_id))
    crew    ⋉ base -> ⋈ person -> nest     -> directors array (hash(movie_id))
    base ⟕ directors ⟕ actors              -> reuses the movie_id partitioning

The semi joins drop credits of titles that cannot reach the fact before the
person join and the per-title grouping, which is where the volume is.  Done
before the person join, they also keep the per-title top-k's partial limit in
front of the shuffle on the title id (a hot title never reaches one task
whole).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import (ACTOR_STAGE, DIRECTOR_STAGE, PERSON_TIER,
                                      RATING_CATEGORY, ROLE_TYPE, age, band)
from marquee.operators.nest import nest_in_runs, nest_ordered, nest_topk
from marquee.operators.person_stats import career_stats, person_movie_rows
from marquee.operators.unnest import unnest_with_pos

TOP_ACTORS = 10
LEAD_POSITION = 1  # 0-based offset counted as "lead" by the original marts

MOVIE_FLAT_COLS = ("movie_id", "title", "original_title", "runtime_minutes", "release_year",
                   "genres", "average_rating", "num_votes", "rating_category",
                   "director_count", "actor_count")


def directors_agg(stg_crew: DataFrame, run_rows: int | None = None) -> DataFrame:
    """Directors of a title by name.  ``run_rows``: titles with more directors are built from runs."""
    named = stg_crew.filter(F.col("director_name").isNotNull() & F.col("director_id").isNotNull())
    order, years = ["director_name", "director_id"], [F.col("birth_year"), F.col("death_year")]
    if run_rows:
        person = [F.col("director_id").alias("id"), F.col("director_name").alias("name")]
        return nest_in_runs(named, "movie_id", order, person + years, "directors", run_rows)
    return nest_ordered(named, "movie_id", order, years, "directors", {"id": 1, "name": 0})


def actors_agg(stg_actor: DataFrame, k: int = TOP_ACTORS) -> DataFrame:
    named = stg_actor.filter(F.col("actor_name").isNotNull() & F.col("actor_id").isNotNull())
    return nest_topk(
        named, "movie_id", ["ordering", "actor_id", "characters"],
        [F.col("actor_id").alias("id"), F.col("actor_name").alias("name"),
         F.col("birth_year"), F.col("death_year"), F.col("characters"), F.col("gender")],
        k, "actors")


def movies_core(stg_title_basics: DataFrame, stg_ratings: DataFrame) -> DataFrame:
    """The fact table's own columns (no people arrays): titles ⋈ ratings + band."""
    return (stg_title_basics.join(stg_ratings, "movie_id")
            .withColumn("rating_category", band("average_rating", *RATING_CATEGORY)))


def movie_ids(stg_title_basics: DataFrame, stg_ratings: DataFrame) -> DataFrame:
    """Ids of the titles that reach the fact table (titles ⋈ ratings)."""
    return stg_title_basics.join(stg_ratings, "movie_id").select("movie_id")


def movies(stg_title_basics: DataFrame, stg_ratings: DataFrame, stg_crew: DataFrame,
           stg_actor: DataFrame, k: int = TOP_ACTORS, prefiltered: bool = False) -> DataFrame:
    """One row per rated movie with ordered ``directors`` and top-``k`` ``actors``.

    ``prefiltered``: the crew and actor inputs were already restricted to
    :func:`movie_ids` before their person joins (the plan used by
    :class:`marquee.plans.pipeline.Models`); otherwise they are restricted here.
    """
    base = stg_title_basics.join(stg_ratings, "movie_id")
    if not prefiltered:
        ids = base.select("movie_id")
        stg_crew = stg_crew.join(ids, "movie_id", "left_semi")
        stg_actor = stg_actor.join(ids, "movie_id", "left_semi")
    return movies_from_base(base, stg_crew, stg_actor, k)


def movies_from_base(base: DataFrame, stg_crew: DataFrame, stg_actor: DataFrame,
                     k: int = TOP_ACTORS) -> DataFrame:
    """The fact from a base (titles with ratings) and the people credited on its titles."""
    d = directors_agg(stg_crew)
    a = actors_agg(stg_actor, k)
    return (base.join(d, "movie_id", "left").join(a, "movie_id", "left")
                .select("movie_id", "title", "original_title", "runtime_minutes",
                        "release_year", "genres", "average_rating", "num_votes",
                        band("average_rating", *RATING_CATEGORY).alias("rating_category"),
                        "directors", "actors",
                        F.array_size("directors").cast("bigint").alias("director_count"),
                        F.array_size("actors").cast("bigint").alias("actor_count")))


def movies_flat(m: DataFrame) -> DataFrame:
    return m.select(*MOVIE_FLAT_COLS)


def movies_directors(m: DataFrame) -> DataFrame:
    """The directors arrays flattened with their 0-based position."""
    return (unnest_with_pos(m, "directors", "d", keep=["movie_id"])
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("d.id").alias("director_id"), F.col("d.name").alias("director_name"),
                    F.col("d.birth_year").alias("birth_year"),
                    F.col("d.death_year").alias("death_year")))


def movies_actors(m: DataFrame) -> DataFrame:
    """The actors arrays flattened with their 0-based position."""
    return (unnest_with_pos(m, "actors", "a", keep=["movie_id"])
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("a.id").alias("actor_id"), F.col("a.name").alias("actor_name"),
                    F.col("a.birth_year").alias("birth_year"),
                    F.col("a.death_year").alias("death_year"),
                    F.col("a.characters").alias("characters"), F.col("a.gender").alias("gender")))


STAT_COLS = ("total_movies", "avg_movie_rating", "total_votes", "first_movie_year",
             "latest_movie_year", "career_span_years", "best_movie_rating",
             "best_movie_title", "best_movie_id", "best_movie_year")


def _person_cols(prefix: str):
    return [F.col("person_id").alias(f"{prefix}_id"), F.col("name").alias(f"{prefix}_name"),
            "birth_year", "death_year", "profession", "known_for_titles"]


def dim_directors(m: DataFrame, stg_person: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per director of the fact table with career statistics and bands."""
    stats = career_stats(person_movie_rows(m, "directors"))
    p = stg_person
    return (stats.join(p, "person_id")
                 .select(*_person_cols("director"),
                         age("birth_year", "death_year", as_of).alias("age"),
                         *STAT_COLS,
                         band("avg_movie_rating", *PERSON_TIER).alias("director_tier"),
                         band("total_movies", *DIRECTOR_STAGE).alias("career_stage")))


def dim_actors(m: DataFrame, stg_person: DataFrame, as_of: str | None = None,
               lead_position: int = LEAD_POSITION) -> DataFrame:
    """One row per (actor, gender) of the fact table; statistics are per actor.

    ``lead_position`` is the 0-based array offset counted as a lead role; the
    default 1 reproduces the original marts (second billing), 0 is the top.
    """
    stats = career_stats(person_movie_rows(m, "actors", lead_position, with_gender=True),
                         lead=True, gender=True)
    per_gender = stats.select("*", F.explode("genders").alias("gender")).drop("genders")
    return (per_gender.join(stg_person, "person_id")
                      .select(*_person_cols("actor"), "gender",
                              age("birth_year", "death_year", as_of).alias("age"),
                              *STAT_COLS, "lead_role_count", "lead_role_percentage",
                              band("avg_movie_rating", *PERSON_TIER).alias("actor_tier"),
                              band("total_movies", *ACTOR_STAGE).alias("career_stage"),
                              band("lead_role_percentage", *ROLE_TYPE).alias("role_type")))
