"""Staging models: clean, rename and type the bronze tables.

Each function takes bronze DataFrames and returns a lazy DataFrame (the
equivalent of a view).  Filters sit directly on the scans so Catalyst pushes
them into the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import decode_gender, safe_int, trim_ws
from marquee.operators.skew import salted_left_join
from marquee.schemas import SOURCE_NULL

MIN_YEAR = 1950
MIN_VOTES = 10_000
BIRTH_RANGE = (1800, 2020)
ACTING = ("actor", "actress")


def stg_title_basics(title_basics: DataFrame, min_year: int = MIN_YEAR) -> DataFrame:
    """Movies only, not adult, released after ``min_year`` (strict), titled."""
    year = safe_int("startYear")
    return (title_basics
            .filter((F.col("titleType") == "movie") & (F.col("isAdult") == 0)
                    & (year > min_year) & (F.col("primaryTitle") != ""))
            .select(F.col("tconst").alias("movie_id"),
                    F.col("primaryTitle").alias("title"),
                    F.col("originalTitle").alias("original_title"),
                    safe_int("runtimeMinutes").alias("runtime_minutes"),
                    year.alias("release_year"),
                    F.col("genres")))


def stg_ratings(title_ratings: DataFrame, min_votes: int = MIN_VOTES) -> DataFrame:
    """Rated titles with more than ``min_votes`` votes (strict) and sane values."""
    r, v = F.col("averageRating"), F.col("numVotes")
    return (title_ratings
            .filter((v > min_votes) & r.between(0, 10))
            .select(F.col("tconst").alias("movie_id"),
                    r.alias("average_rating"),
                    v.alias("num_votes")))


def stg_person(name_basics: DataFrame, birth_range: tuple[int, int] = BIRTH_RANGE) -> DataFrame:
    """People with a plausible birth year, a name and known-for titles."""
    birth = safe_int("birthYear")
    return (name_basics
            .filter(birth.between(*birth_range) & (F.col("knownForTitles") != "")
                    & (F.col("primaryName") != ""))
            .select(F.col("nconst").alias("person_id"),
                    F.col("primaryName").alias("name"),
                    birth.alias("birth_year"),
                    safe_int("deathYear").alias("death_year"),
                    F.col("primaryProfession").alias("profession"),
                    F.col("knownForTitles").alias("known_for_titles")))


def exploded_directors(title_crew: DataFrame) -> DataFrame:
    """One row per (title, director id) from the comma-separated list."""
    d = F.col("directors")
    return (title_crew
            .filter((d != SOURCE_NULL) & d.isNotNull() & (d != ""))
            .select(F.col("tconst").alias("movie_id"),
                    F.explode(F.split(d, ",")).alias("_d"))
            .select("movie_id", trim_ws("_d").alias("director_id"))
            .filter(F.col("director_id") != ""))


def _only_titles(df: DataFrame, id_col: str, movie_ids: DataFrame | None) -> DataFrame:
    """Keep rows of the given titles (whole titles: per-title results are unchanged)."""
    if movie_ids is None:
        return df
    ids = movie_ids.select(F.col("movie_id").alias("_keep_id"))
    return df.join(ids, F.col(id_col) == F.col("_keep_id"), "left_semi")


def _with_person(credits: DataFrame, person: DataFrame, id_col: str, spread: list[str],
                 hot_people: Sequence[str]) -> DataFrame:
    """Credits left-joined to people; ``hot_people`` are spread over several tasks."""
    if hot_people:
        return salted_left_join(credits, person, id_col, "person_id", hot_people, spread)
    return credits.join(person, F.col(id_col) == F.col("person_id"), "left")


def stg_crew(title_crew: DataFrame, person: DataFrame,
             movie_ids: DataFrame | None = None, hot_people: Sequence[str] = ()) -> DataFrame:
    """Director credits enriched with person data (left join keeps orphans).

    ``movie_ids`` restricts the crew to those titles *before* the person
    join, so the join and every later shuffle only carry credits that can
    reach the fact table.  ``hot_people`` are joined with salt.
    """
    p = person.select("person_id", F.col("name").alias("director_name"),
                      "birth_year", "death_year", "profession")
    return (_with_person(_only_titles(exploded_directors(title_crew), "movie_id", movie_ids),
                         p, "director_id", ["movie_id"], hot_people)
            .select("movie_id", "director_id", "director_name", "birth_year",
                    "death_year", "profession"))


def acting_credits(title_principals: DataFrame) -> DataFrame:
    return (title_principals
            .filter(F.col("category").isin(*ACTING) & F.col("nconst").isNotNull()
                    & F.col("tconst").isNotNull())
            .select(F.col("tconst").alias("movie_id"), "ordering",
                    F.col("nconst").alias("actor_id"), "category", "characters"))


def stg_actor(title_principals: DataFrame, person: DataFrame,
              movie_ids: DataFrame | None = None, hot_people: Sequence[str] = ()) -> DataFrame:
    """Acting credits with gender decoded and person data (left join).

    ``movie_ids`` restricts the credits to those titles before the person
    join (see :func:`stg_crew`); the last shuffle before the per-title top-k
    is then the one on the person id, so the top-k's partial limit runs
    before the shuffle on the title id.  ``hot_people`` (see
    :func:`marquee.operators.skew.hot_keys`) are joined with salt.
    """
    p = person.select("person_id", F.col("name").alias("actor_name"),
                      "birth_year", "death_year", "profession")
    return (_with_person(_only_titles(acting_credits(title_principals), "movie_id", movie_ids),
                         p, "actor_id", ["movie_id", "ordering"], hot_people)
            .select("movie_id", "ordering", "actor_id", "actor_name", "category",
                    decode_gender("category").alias("gender"), "characters",
                    "birth_year", "death_year", "profession"))
