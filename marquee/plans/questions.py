"""Analytical questions over the marts (the example question set of the chat
front end, written as DataFrame plans).

Nested-array predicates use higher-order ``exists`` / ``array_contains`` over
one struct field: no self-join, and the Parquet scan reads only that field.
Every ranking ends with ``movie_id`` (or person id) so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalar import csv_contains, decade
from marquee.operators.unnest import any_match, unnest_fields
from marquee.sources.sinks import decade_filter

MOVIE_OUT = ("movie_id", "title", "release_year", "average_rating", "num_votes")


def _best(df: DataFrame):
    return df.orderBy(F.col("average_rating").desc(), F.col("num_votes").desc(),
                      F.col("movie_id").asc())


def top_rated(m: DataFrame, n: int = 10) -> DataFrame:
    """Q1: the ``n`` highest-rated movies (global top-k)."""
    return _best(m.select(*MOVIE_OUT)).limit(n)


def movies_by_director_like(m: DataFrame, pattern: str, n: int = 10) -> DataFrame:
    """Q2: best movies with a director whose name matches a LIKE pattern."""
    return _best(m.filter(any_match("directors", "name", lambda x: x.like(pattern)))
                  .select(*MOVIE_OUT)).limit(n)


def filmography(m: DataFrame, director_name: str) -> DataFrame:
    """Q2: every movie of one director, by release year."""
    return (m.filter(F.array_contains(F.col("directors.name"), director_name))
             .select(*MOVIE_OUT).orderBy("release_year", "movie_id"))


def actors_with_director(m: DataFrame, director_pattern: str) -> DataFrame:
    """Q3: actors credited on movies of matching directors, with movie counts."""
    hit = m.filter(any_match("directors", "name", lambda x: x.like(director_pattern)))
    cast = unnest_fields(hit, "actors", ["id", "name"], keep=["movie_id"])
    return (cast.groupBy(F.col("id").alias("actor_id"), F.col("name").alias("actor_name"))
                .agg(F.countDistinct("movie_id").alias("movies_together")))


def best_of_decade(m: DataFrame, decade_start: int, n: int = 10) -> DataFrame:
    """Q4: best movies of one decade (prunes decade partitions when ``m`` is the
    partitioned table)."""
    return _best(decade_filter(m, decade_start, decade_start + 9).select(*MOVIE_OUT)).limit(n)


def collaboration(m: DataFrame, actor_pattern: str, director_pattern: str) -> DataFrame:
    """Q5: movies where a matching actor and a matching director both appear."""
    return _best(m.filter(any_match("actors", "name", lambda x: x.like(actor_pattern))
                          & any_match("directors", "name", lambda x: x.like(director_pattern)))
                  .select(*MOVIE_OUT))


def prolific_directors(dim_directors: DataFrame, n: int = 10) -> DataFrame:
    """Q6: directors with the most movies, from the director dimension."""
    return (dim_directors.select("director_id", "director_name", "total_movies",
                                 "avg_movie_rating", "career_stage")
            .orderBy(F.desc("total_movies"), F.asc("director_id")).limit(n))


def genre_top(m: DataFrame, genre: str, n: int = 10) -> DataFrame:
    """Q7: highest-rated movies of a genre (comma-list membership)."""
    return _best(m.filter(csv_contains("genres", genre)).select(*MOVIE_OUT, "genres")).limit(n)


def movies_by_actor(m: DataFrame, actor_name: str) -> DataFrame:
    """Q8: an actor's movies, best first (exact name)."""
    return _best(m.filter(F.array_contains(F.col("actors.name"), actor_name)).select(*MOVIE_OUT))


def rating_and_decade(m: DataFrame, min_rating: float, decade_start: int) -> DataFrame:
    """Q9: movies rated at least ``min_rating`` within one decade."""
    return _best(decade_filter(m, decade_start, decade_start + 9)
                 .filter(F.col("average_rating") >= min_rating).select(*MOVIE_OUT))


def directors_most_movies(m: DataFrame, n: int = 10) -> DataFrame:
    """Q10: directors with the most movies, counted from the nested fact."""
    d = unnest_fields(m, "directors", ["id", "name"], keep=["movie_id"])
    return (d.groupBy(F.col("id").alias("director_id"), F.col("name").alias("director_name"))
             .agg(F.countDistinct("movie_id").alias("movies"))
             .orderBy(F.desc("movies"), F.asc("director_id")).limit(n))


def gender_by_decade(m: DataFrame) -> DataFrame:
    """Q11: credits and distinct actors per release decade and gender."""
    a = unnest_fields(m, "actors", ["id", "gender"], keep=["release_year"])
    return (a.groupBy(decade("release_year").alias("decade"), "gender")
             .agg(F.count(F.lit(1)).alias("credits"),
                  F.countDistinct("id").alias("actors")))


SQL_SURFACE_EXAMPLE = """
SELECT dd.director_tier, dd.career_stage,
       count(DISTINCT m.movie_id) AS movies,
       CAST(sum(m.num_votes) AS BIGINT) AS votes,
       max(m.average_rating) AS best_rating
FROM (SELECT m.movie_id, m.num_votes, m.average_rating, d.id AS director_id
      FROM {movies} m LATERAL VIEW explode(m.directors) x AS d
      WHERE exists(m.actors.gender, g -> g = 'Female')) m
JOIN {dim_directors} dd ON dd.director_id = m.director_id
GROUP BY dd.director_tier, dd.career_stage
"""

# The three query shapes of the front end: name pattern, exact name, ranking.
SQL_BY_DIRECTOR = """
SELECT movie_id, title, release_year, average_rating FROM {movies}
WHERE exists(directors.name, d -> d LIKE :pattern)
ORDER BY average_rating DESC, num_votes DESC, movie_id LIMIT 10
"""
SQL_BY_ACTOR = """
SELECT movie_id, title, release_year, average_rating FROM {movies}
WHERE exists(actors.name, a -> a = :name)
ORDER BY average_rating DESC, num_votes DESC, movie_id
"""
SQL_TOP = """
SELECT movie_id, title, release_year, average_rating FROM {movies}
ORDER BY average_rating DESC, num_votes DESC, movie_id LIMIT :n
"""
# ``UNNEST`` as a table function: people of one array with their position.
SQL_UNNEST_PEOPLE = """
SELECT p.gender, p.pos, CAST(count(*) AS BIGINT) AS credits, count(DISTINCT p.id) AS people
FROM {movies} m, LATERAL {unnest_actors}(m.actors) p
WHERE m.release_year >= :since
GROUP BY p.gender, p.pos
"""

TABLE_FUNCTIONS = {
    "unnest_directors": ("directors", "id STRING, name STRING, birth_year BIGINT, death_year BIGINT"),
    "unnest_actors": ("actors", "id STRING, name STRING, birth_year BIGINT, death_year BIGINT, "
                                "characters STRING, gender STRING"),
}


def register_table_functions(spark: SparkSession, prefix: str = "marquee_") -> dict[str, str]:
    """SQL table functions that stand for ``UNNEST(arr) WITH OFFSET``: name -> registered name."""
    out = {}
    for name, (_, fields) in TABLE_FUNCTIONS.items():
        struct = ", ".join(f"{c}: {t}" for c, t in (f.split(" ") for f in fields.split(", ")))
        cols = ", ".join(f"e.col.{f.split(' ')[0]}" for f in fields.split(", "))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(people ARRAY<STRUCT<{struct}>>) "
                  f"RETURNS TABLE (pos BIGINT, {fields}) "
                  f"RETURN SELECT CAST(e.pos AS BIGINT), {cols} FROM posexplode(people) AS e(pos, col)")
        out[name] = f"{prefix}{name}"
    return out


def sql_surface(spark: SparkSession, marts: dict[str, DataFrame], text: str,
                args: dict | None = None) -> DataFrame:
    """Q12: ad-hoc Spark SQL over the marts.

    ``{movies}`` and the like stand for the marts, ``{unnest_actors}`` and
    ``{unnest_directors}`` for the table functions, ``:name`` for a value of
    ``args``.  The marts are bound under generated names for this statement
    only, so views of the session are neither seen as marts nor replaced.
    """
    functions = {}
    if any(f"{{{n}}}" in text for n in TABLE_FUNCTIONS):
        functions = register_table_functions(spark)
    for name, registered in functions.items():
        text = text.replace(f"{{{name}}}", registered)
    used = {n: df for n, df in marts.items() if f"{{{n}}}" in text}
    return spark.sql(text, args=args, **used)
