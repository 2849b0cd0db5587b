"""Per-person career statistics from a nested fact table.

Step 1 (:func:`person_movie_rows`) explodes the fields it needs of each
movie's people array, one row per credit, partitioned by movie; the other
fields are not read.
Step 2 (:func:`career_stats`) is one ``groupBy(person)`` with partial
aggregation.  Means and sums are per credit (a person listed twice weighs
twice); the movie count is per distinct movie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.numeric import MEAN_TYPE, exact_mean, rounded_share

MOVIE_COLS = ("movie_id", "title", "average_rating", "num_votes", "release_year")


def person_movie_rows(movies: DataFrame, array_col: str, lead_position: int | None = None,
                      with_gender: bool = False) -> DataFrame:
    """One row per credit: movie columns, person id (and lead flag, gender)."""
    fields = ["id", "gender"] if with_gender else ["id"]
    zipped = F.arrays_zip(*[F.col(f"{array_col}.{f}") for f in fields])
    names = movies.select(zipped.alias("z")).schema["z"].dataType.elementType.names
    # whole movies move by their id, still as arrays: the distinct (person, movie)
    # of career_stats then needs no shuffle of its own over the credits
    by_movie = movies.select(*MOVIE_COLS, zipped.alias("_z")).repartition("movie_id")
    rows = by_movie.select(*MOVIE_COLS, F.posexplode("_z").alias("_pos", "_p"))
    out = [F.col("_p")[names[0]].alias("person_id")]
    if lead_position is not None:
        out.append((F.col("_pos") == lead_position).cast("bigint").alias("lead_credits"))
    if with_gender:
        out.append(F.col("_p")[names[1]].alias("gender"))
    return rows.select(*MOVIE_COLS, *out).filter("person_id IS NOT NULL")


def career_stats(rows: DataFrame, lead: bool = False, gender: bool = False) -> DataFrame:
    """Statistics per ``person_id`` from :func:`person_movie_rows` output."""
    rating = F.col("average_rating")
    aggs = [
        F.countDistinct("movie_id").cast("bigint").alias("total_movies"),
        F.sum(rating.cast(MEAN_TYPE)).alias("_wsum"),
        F.count(F.lit(1)).alias("_credits"),
        F.sum("num_votes").cast("bigint").alias("total_votes"),
        F.min("release_year").alias("first_movie_year"),
        F.max("release_year").alias("latest_movie_year"),
        F.max(rating).alias("best_movie_rating"),
        # best movie: rating desc, votes desc, then movie id for determinism
        # (title and year only part rows of one movie id; each value travels once)
        F.min(F.struct((-rating).alias("_r"), (-F.col("num_votes")).alias("_v"),
                       "movie_id", "title", "release_year")).alias("_best"),
    ]
    if lead:
        aggs.append(F.sum("lead_credits").cast("bigint").alias("lead_role_count"))
    if gender:
        aggs.append(F.array_sort(F.collect_set("gender")).alias("genders"))
    s = rows.groupBy("person_id").agg(*aggs)
    # one projection (each withColumn would re-analyse the whole plan)
    derived = [
        exact_mean(F.col("_wsum"), F.col("_credits")).alias("avg_movie_rating"),
        (F.col("latest_movie_year") - F.col("first_movie_year")).alias("career_span_years"),
        F.col("_best.title").alias("best_movie_title"),
        F.col("_best.movie_id").alias("best_movie_id"),
        F.col("_best.release_year").alias("best_movie_year"),
    ]
    if lead:
        derived.append(rounded_share(F.col("lead_role_count"), F.col("_credits"))
                       .alias("lead_role_percentage"))
    keep = [c for c in s.columns if c not in ("_wsum", "_best", "_credits")]
    return s.select(*keep, *derived)
