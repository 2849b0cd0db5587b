"""Wiring of the models (what the model DAG resolves to) and a full build.

``Models`` holds lazy DataFrames; ``build`` materialises the three marts as
Parquet tables, ``movies`` first, so the dimensions read the written fact
(the lineage to the raw tables is cut there).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import marts, staging
from marquee.sources.bindings import bronze_tables


@dataclass
class Params:
    min_year: int = staging.MIN_YEAR
    min_votes: int = staging.MIN_VOTES
    top_actors: int = marts.TOP_ACTORS
    lead_position: int = marts.LEAD_POSITION
    as_of: str | None = None          # None -> current_date()
    na_tokens: tuple | None = None    # None -> default token list


# Queries pin the reference date so that ages are reproducible.
FIXED_AS_OF = "2026-01-01"


@dataclass
class Models:
    bronze: Mapping[str, DataFrame]
    params: Params = field(default_factory=Params)
    _cache: dict = field(default_factory=dict)

    def _get(self, name, make):
        if name not in self._cache:
            self._cache[name] = make()
        return self._cache[name]

    @property
    def stg_title_basics(self) -> DataFrame:
        return self._get("stg_title_basics", lambda: staging.stg_title_basics(
            self.bronze["title_basics"], self.params.min_year))

    @property
    def stg_ratings(self) -> DataFrame:
        return self._get("stg_ratings", lambda: staging.stg_ratings(
            self.bronze["title_ratings"], self.params.min_votes))

    @property
    def stg_person(self) -> DataFrame:
        return self._get("stg_person", lambda: staging.stg_person(self.bronze["name_basics"]))

    @property
    def stg_crew(self) -> DataFrame:
        return self._get("stg_crew", lambda: staging.stg_crew(
            self.bronze["title_crew"], self.stg_person))

    @property
    def stg_actor(self) -> DataFrame:
        return self._get("stg_actor", lambda: staging.stg_actor(
            self.bronze["title_principals"], self.stg_person))

    @property
    def movies_core(self) -> DataFrame:
        """Fact columns without the people arrays (for questions that need no people)."""
        return self._get("movies_core", lambda: marts.movies_core(
            self.stg_title_basics, self.stg_ratings))

    @property
    def movie_ids(self) -> DataFrame:
        return self._get("movie_ids", lambda: marts.movie_ids(
            self.stg_title_basics, self.stg_ratings))

    @property
    def movies(self) -> DataFrame:
        # crew and credits restricted to the surviving titles before their
        # person joins (same rows for those titles as the staging views)
        def make():
            crew = staging.stg_crew(self.bronze["title_crew"], self.stg_person, self.movie_ids)
            actor = staging.stg_actor(self.bronze["title_principals"], self.stg_person,
                                      self.movie_ids)
            return marts.movies(self.stg_title_basics, self.stg_ratings, crew, actor,
                                self.params.top_actors, prefiltered=True)
        return self._get("movies", make)

    @property
    def dim_directors(self) -> DataFrame:
        return self._get("dim_directors", lambda: marts.dim_directors(
            self.movies, self.stg_person, self.params.as_of))

    @property
    def dim_actors(self) -> DataFrame:
        return self._get("dim_actors", lambda: marts.dim_actors(
            self.movies, self.stg_person, self.params.as_of, self.params.lead_position))


def models_from_fixtures(spark: SparkSession, sf_dir: str, params: Params | None = None) -> Models:
    params = params or Params(as_of=FIXED_AS_OF)
    return Models(bronze_tables(spark, sf_dir, params.na_tokens), params)


def models_from_tables(spark: SparkSession, bronze_dir: str, params: Params | None = None,
                       names=None) -> Models:
    """Models over bronze Parquet tables written by :mod:`marquee.sources.refresh`."""
    from marquee.sources.bindings import BOUND_TABLES
    names = names or BOUND_TABLES
    b = {n: spark.read.parquet(f"{bronze_dir.rstrip('/')}/{n}") for n in names}
    return Models(b, params or Params())


def build(models: Models, silver_dir: str) -> dict[str, str]:
    """Write movies, then both dimensions computed from the written movies."""
    from marquee.sources.sinks import write_movies_partitioned, write_table
    spark = models.movies.sparkSession
    root = silver_dir.rstrip("/")
    out = {"movies": f"{root}/movies"}
    write_movies_partitioned(models.movies, out["movies"])
    written = spark.read.parquet(out["movies"]).drop("release_decade")
    p = models.params
    dims = {
        "dim_directors": marts.dim_directors(written, models.stg_person, p.as_of),
        "dim_actors": marts.dim_actors(written, models.stg_person, p.as_of, p.lead_position),
    }
    for name, df in dims.items():
        out[name] = f"{root}/{name}"
        write_table(df, out[name])
    return out
