"""Named queries over the fixture tables: one per operator / model / question.

Each entry takes ``(spark, sf_dir)`` and returns a flat DataFrame (no arrays
or structs, integers as BIGINT) so it can be compared with the DuckDB oracle
in :mod:`marquee.oracle` by row count, schema and value hash.  Parameters of
the questions are fixed here; the fixture names look like
``Customer#000000078``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalar import (ACTOR_STAGE, DIRECTOR_STAGE, PERSON_TIER,
                                      RATING_CATEGORY, ROLE_TYPE, age, band, decode_gender,
                                      safe_int)
from marquee.operators import quality
from marquee.operators.skew import hot_keys
from marquee.operators.person_stats import career_stats, person_movie_rows
from marquee.operators.unnest import unnest, unnest_fields, unnest_with_pos
from marquee.plans import marts, questions, staging, usage
from marquee.plans.pipeline import FIXED_AS_OF, Models, Params, models_from_fixtures
from marquee.plans.warehouse import MARTS, Warehouse
from marquee.session import exists, scratch_path
from marquee.sources import bindings, sinks, tsv
from marquee.sources.bindings import read_driver

# Fixed question parameters (fixture names and patterns).
DIRECTOR_LIKE = "%00012%"
ACTOR_LIKE = "%00003%"
DIRECTOR_NAME = "Customer#000000078"
ACTOR_NAME = "Customer#000000763"
GENRE = "Sci-Fi"
DECADE = 1990
HIGH_RATING = 9.0
HIGH_DECADE = 2010
ALT_MIN_YEAR = 1999
ALT_MIN_VOTES = 150_000
SQL_TOP_N = 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _m(spark: SparkSession, sf_dir: str) -> Models:
    return models_from_fixtures(spark, sf_dir)


_warehouses: dict[tuple, Warehouse] = {}


def new_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse of its own under the scratch root: bronze tables on disk, marts not built yet."""
    root = scratch_path(spark, "warehouse")
    w = Warehouse(spark, root, f"marquee_{root[-12:]}_", params=Params(as_of=FIXED_AS_OF))
    w.load_bronze(bindings.bronze_tables(spark, sf_dir))
    return w


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The written tables of ``sf_dir``, built once for an application and state of its inputs."""
    key = (spark.sparkContext.applicationId, sf_dir, bindings.fingerprint(spark, sf_dir))
    w = _warehouses.get(key)
    if w is None or not (exists(spark, w.path("layout")) and spark.catalog.tableExists(f"{w.prefix}movies")):
        w = new_warehouse(spark, sf_dir)
        w.build()
        _warehouses[key] = w
    return w


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse(spark, sf_dir).table(name)


def _marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    w = warehouse(spark, sf_dir)
    return {n: w.table(n) for n in MARTS}


@query
def build_marts(spark, sf_dir):
    """Bronze, base, people and marts written anew; rows of each table and what its buckets hold."""
    w = new_warehouse(spark, sf_dir)
    return w.build().select("table_name", "rows", F.col("buckets").isNotNull().alias("bucketed"))


@query
def build_attach(spark, sf_dir):
    """The written dimension, found again by another catalog prefix."""
    w = warehouse(spark, sf_dir)
    again = Warehouse(spark, w.root, f"{w.prefix}again_").attach()
    return again.table("dim_directors")


@query
def bronze_akas(spark, sf_dir):
    return warehouse(spark, sf_dir).table("title_akas")


@query
def bronze_episode(spark, sf_dir):
    return warehouse(spark, sf_dir).table("title_episode")


def _bigint_ints(df: DataFrame) -> DataFrame:
    """Cast int/short/byte columns to BIGINT (compared schemas use BIGINT)."""
    from pyspark.sql import types as T
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------- staging (I1-I5)
@query
def stg_title_basics(spark, sf_dir):
    return _m(spark, sf_dir).stg_title_basics


@query
def stg_ratings(spark, sf_dir):
    return _m(spark, sf_dir).stg_ratings


@query
def stg_person(spark, sf_dir):
    return _m(spark, sf_dir).stg_person


@query
def stg_crew(spark, sf_dir):
    return _m(spark, sf_dir).stg_crew


@query
def stg_actor(spark, sf_dir):
    return _m(spark, sf_dir).stg_actor


# ---------------------------------------------------------------- marts (I6-I8)
@query
def movies_flat(spark, sf_dir):
    return marts.movies_flat(_mart(spark, sf_dir, "movies"))


@query
def movies_directors(spark, sf_dir):
    return marts.movies_directors(_mart(spark, sf_dir, "movies"))


@query
def movies_actors(spark, sf_dir):
    return marts.movies_actors(_mart(spark, sf_dir, "movies"))


@query
def dim_directors(spark, sf_dir):
    return _mart(spark, sf_dir, "dim_directors")


@query
def dim_actors(spark, sf_dir):
    return _mart(spark, sf_dir, "dim_actors")


# ---------------------------------------------------------------- filters / projections
@query
def flt_safe_cast(spark, sf_dir):
    tb = bindings.bronze(spark, sf_dir, "title_basics")
    return tb.select("tconst", safe_int("startYear").alias("start_year"),
                     safe_int("runtimeMinutes").alias("runtime_minutes"))


@query
def flt_threshold_param(spark, sf_dir):
    m = models_from_fixtures(spark, sf_dir, Params(min_year=ALT_MIN_YEAR,
                                                   min_votes=ALT_MIN_VOTES, as_of=FIXED_AS_OF))
    return (m.stg_title_basics.join(m.stg_ratings, "movie_id")
             .select("movie_id", "release_year", "num_votes"))


@query
def prj_gender_decode(spark, sf_dir):
    pr = bindings.bronze(spark, sf_dir, "title_principals")
    return pr.select("tconst", "ordering", "category", decode_gender("category").alias("gender"))


@query
def prj_age(spark, sf_dir):
    p = _m(spark, sf_dir).stg_person
    return p.select("person_id", "birth_year", "death_year",
                    age("birth_year", "death_year", FIXED_AS_OF).alias("age"))


def _ladder(df, col, ladder, name, keep):
    return df.select(*keep, col, band(col, *ladder).alias(name))


def _ladder_keep_all(df, col, ladder, name):
    return df.select("*", band(col, *ladder).alias(name))


@query
def band_rating_category(spark, sf_dir):
    return _ladder(_m(spark, sf_dir).stg_ratings, "average_rating", RATING_CATEGORY,
                   "rating_category", ["movie_id"])


@query
def band_person_tier(spark, sf_dir):
    return _ladder(_m(spark, sf_dir).stg_ratings, "average_rating", PERSON_TIER,
                   "tier", ["movie_id"])


def _sizes(spark, sf_dir):
    return read_driver(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("p_size"))


@query
def band_actor_stage(spark, sf_dir):
    return _ladder(_sizes(spark, sf_dir), "p_size", ACTOR_STAGE, "career_stage", ["p_partkey"])


@query
def band_director_stage(spark, sf_dir):
    return _ladder(_sizes(spark, sf_dir), "p_size", DIRECTOR_STAGE, "career_stage", ["p_partkey"])


@query
def band_role_type(spark, sf_dir):
    p = _sizes(spark, sf_dir).withColumn("pct", F.col("p_size") * 2.0)
    return _ladder_keep_all(p, "pct", ROLE_TYPE, "role_type")


# ---------------------------------------------------------------- joins
@query
def join_titles_ratings(spark, sf_dir):
    m = _m(spark, sf_dir)
    return (m.stg_title_basics.join(m.stg_ratings, "movie_id")
             .select("movie_id", "title", "release_year", "average_rating", "num_votes"))


@query
def join_actor_person_left(spark, sf_dir):
    a = _m(spark, sf_dir).stg_actor
    return a.select("movie_id", "ordering", "actor_id", "actor_name",
                    F.col("actor_name").isNotNull().alias("has_person"))


HOT_PERSON = "nm0000002"


@query
def join_hot_person(spark, sf_dir):
    """Acting credits, half of them of one person, joined to people with salt."""
    hot = F.floor(F.col("ordering") / 16) % 2 == 0
    credits = bindings.bronze(spark, sf_dir, "title_principals").withColumn(
        "nconst", F.when(hot, F.lit(HOT_PERSON)).otherwise(F.col("nconst")))
    found = hot_keys(staging.acting_credits(credits), "actor_id", share=0.1)
    a = staging.stg_actor(credits, _m(spark, sf_dir).stg_person, hot_people=found)
    return a.select("movie_id", "ordering", "actor_id", "actor_name", "birth_year")


@query
def unnest_directors(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return unnest(m, "directors.id", "director_id", keep=["movie_id"])


@query
def unnest_actors_pos(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return (unnest_fields(m, "actors", ["id", "gender"], keep=["movie_id"], pos="pos")
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("id").alias("actor_id"), "gender"))


@query
def explode_directors(spark, sf_dir):
    return staging.exploded_directors(bindings.bronze(spark, sf_dir, "title_crew"))


@query
def arr_lengths(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return m.select("movie_id", "director_count", "actor_count")


@query
def arr_first(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return m.select("movie_id", F.get("directors", 0)["id"].alias("first_director_id"),
                    F.get("actors", 0)["id"].alias("first_actor_id"))


# ---------------------------------------------------------------- aggregations
@query
def nest_directors(spark, sf_dir):
    d = marts.directors_agg(_m(spark, sf_dir).stg_crew)
    return (unnest_with_pos(d, "directors", "d", keep=["movie_id"])
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("d.id").alias("director_id"), F.col("d.name").alias("director_name")))


@query
def nest_directors_runs(spark, sf_dir):
    """Directors arrays of titles with more than two directors, built from runs of two."""
    d = marts.directors_agg(_m(spark, sf_dir).stg_crew, run_rows=2)
    return (unnest_with_pos(d, "directors", "d", keep=["movie_id"])
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("d.id").alias("director_id"), F.col("d.name").alias("director_name")))


@query
def nest_topk_actors(spark, sf_dir):
    a = marts.actors_agg(_m(spark, sf_dir).stg_actor)
    return (unnest_with_pos(a, "actors", "a", keep=["movie_id"])
            .select("movie_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("a.id").alias("actor_id"), F.col("a.name").alias("actor_name")))


def _director_stats(spark, sf_dir):
    return career_stats(person_movie_rows(_mart(spark, sf_dir, "movies"), "directors"))


def _actor_stats(spark, sf_dir):
    rows = person_movie_rows(_mart(spark, sf_dir, "movies"), "actors", marts.LEAD_POSITION)
    return career_stats(rows, lead=True)


@query
def agg_count_distinct(spark, sf_dir):
    return _director_stats(spark, sf_dir).select("person_id", "total_movies")


@query
def agg_avg_rounded(spark, sf_dir):
    return _actor_stats(spark, sf_dir).select("person_id", "avg_movie_rating")


@query
def agg_sum_votes(spark, sf_dir):
    return _director_stats(spark, sf_dir).select("person_id", "total_votes")


@query
def agg_career_span(spark, sf_dir):
    return _director_stats(spark, sf_dir).select("person_id", "first_movie_year",
                                                 "latest_movie_year", "career_span_years")


@query
def agg_argmax_best(spark, sf_dir):
    return _actor_stats(spark, sf_dir).select("person_id", "best_movie_rating", "best_movie_id",
                                              "best_movie_title", "best_movie_year")


@query
def agg_countif_share(spark, sf_dir):
    return _actor_stats(spark, sf_dir).select("person_id", "lead_role_count",
                                              "lead_role_percentage")


@query
def agg_distinct_people(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return (unnest_fields(m, "actors", ["id", "gender"])
            .filter(F.col("id").isNotNull())
            .select(F.col("id").alias("actor_id"), "gender").distinct())


@query
def agg_count_star(spark, sf_dir):
    m = _mart(spark, sf_dir, "movies")
    return (unnest_fields(m, "actors", ["id"]).groupBy(F.col("id").alias("actor_id"))
            .agg(F.count(F.lit(1)).alias("credits")))


# ---------------------------------------------------------------- questions (Q1-Q12)
@query
def q_top_rated(spark, sf_dir):
    return questions.top_rated(_mart(spark, sf_dir, "movies"))


@query
def q_movies_by_director_like(spark, sf_dir):
    return questions.movies_by_director_like(_mart(spark, sf_dir, "movies"), DIRECTOR_LIKE)


@query
def q_filmography(spark, sf_dir):
    return questions.filmography(_mart(spark, sf_dir, "movies"), DIRECTOR_NAME)


@query
def q_actors_with_director(spark, sf_dir):
    return questions.actors_with_director(_mart(spark, sf_dir, "movies"), DIRECTOR_LIKE)


@query
def q_best_of_decade(spark, sf_dir):
    return questions.best_of_decade(_mart(spark, sf_dir, "movies"), DECADE)


@query
def q_collaboration(spark, sf_dir):
    return questions.collaboration(_mart(spark, sf_dir, "movies"), ACTOR_LIKE, DIRECTOR_LIKE)


@query
def q_prolific_directors(spark, sf_dir):
    return questions.prolific_directors(_mart(spark, sf_dir, "dim_directors"))


@query
def q_genre_top(spark, sf_dir):
    return questions.genre_top(_mart(spark, sf_dir, "movies"), GENRE)


@query
def q_movies_by_actor_eq(spark, sf_dir):
    return questions.movies_by_actor(_mart(spark, sf_dir, "movies"), ACTOR_NAME)


@query
def q_rating_and_decade(spark, sf_dir):
    return questions.rating_and_decade(_mart(spark, sf_dir, "movies"), HIGH_RATING, HIGH_DECADE)


@query
def q_directors_most_movies(spark, sf_dir):
    return questions.directors_most_movies(_mart(spark, sf_dir, "movies"))


@query
def q_gender_by_decade(spark, sf_dir):
    return questions.gender_by_decade(_mart(spark, sf_dir, "movies"))


@query
def q_sql_surface(spark, sf_dir):
    return questions.sql_surface(spark, _marts(spark, sf_dir), questions.SQL_SURFACE_EXAMPLE)


@query
def q_sql_by_director(spark, sf_dir):
    return questions.sql_surface(spark, _marts(spark, sf_dir), questions.SQL_BY_DIRECTOR,
                                 {"pattern": DIRECTOR_LIKE})


@query
def q_sql_by_actor(spark, sf_dir):
    return questions.sql_surface(spark, _marts(spark, sf_dir), questions.SQL_BY_ACTOR,
                                 {"name": ACTOR_NAME})


@query
def q_sql_top(spark, sf_dir):
    return questions.sql_surface(spark, _marts(spark, sf_dir), questions.SQL_TOP, {"n": SQL_TOP_N})


@query
def q_sql_unnest(spark, sf_dir):
    return questions.sql_surface(spark, _marts(spark, sf_dir), questions.SQL_UNNEST_PEOPLE,
                                 {"since": ALT_MIN_YEAR})


# ---------------------------------------------------------------- data tests (H1-H4)
def _bronze(spark, sf_dir):
    return bindings.bronze_tables(spark, sf_dir)


@query
def dq_unique(spark, sf_dir):
    t = _bronze(spark, sf_dir)
    return quality.run_tests(t, [x for x in quality.SOURCE_TESTS if x[2] == "unique"])


@query
def dq_not_null(spark, sf_dir):
    t = _bronze(spark, sf_dir)
    return quality.run_tests(t, [x for x in quality.SOURCE_TESTS if x[2] == "not_null"])


@query
def dq_relationships(spark, sf_dir):
    t = _bronze(spark, sf_dir)
    return quality.run_tests(t, [x for x in quality.SOURCE_TESTS if x[2] == "relationships"])


@query
def dq_report(spark, sf_dir):
    return quality.run_tests(_bronze(spark, sf_dir))


def _faulty_bronze(spark, sf_dir):
    """Bronze tables with repeated titles and people, titles that are missing and NULLs."""
    t = dict(_bronze(spark, sf_dir))
    k = F.substring("tconst", 3, 20).cast("bigint")
    basics, names = t["title_basics"], t["name_basics"]
    t["title_basics"] = (basics.filter(k % 13 != 5).unionByName(basics.filter(k % 50 == 0))
                         .withColumn("titleType", F.when(k % 17 != 0, F.col("titleType"))))
    t["name_basics"] = names.unionByName(names.filter(F.substring("nconst", 3, 20).cast("bigint") % 40 == 0))
    t["title_ratings"] = t["title_ratings"].withColumn("tconst", F.when(k % 29 != 0, F.col("tconst")))
    return t


@query
def dq_report_faulty(spark, sf_dir):
    return quality.run_tests(_faulty_bronze(spark, sf_dir))


# ---------------------------------------------------------------- sources / sinks
@query
def src_tsv_scan(spark, sf_dir):
    path = tsv.write_tsv(bindings.raw_bronze(spark, sf_dir, "title_basics"),
                         scratch_path(spark, "title_basics_tsv"))
    return _bigint_ints(tsv.read_tsv(spark, path, "title_basics"))


def _ratings_lines(spark, sf_dir, damaged: bool):
    """title_ratings as text with its columns reversed; some rows damaged on request."""
    r = bindings.raw_bronze(spark, sf_dir, "title_ratings").select(
        *(F.col(c).cast("string") for c in ("numVotes", "averageRating", "tconst")),
        (F.substring("tconst", 3, 20).cast("bigint") % 50).alias("k"))
    line = F.concat_ws("\t", "numVotes", "averageRating", "tconst")
    if damaged:
        line = (F.when(F.col("k") == 0, F.col("numVotes"))                  # one field only
                .when(F.col("k") == 1, F.concat(line, F.lit("\tmore")))     # a field too many
                .when(F.col("k") == 2, F.concat_ws("\t", "numVotes", F.lit("high"), "tconst"))
                .otherwise(line))
    path = scratch_path(spark, "ratings-lines")
    (r.select(line.alias("numVotes\taverageRating\ttconst")).write
      .options(sep="\u0001", quote="", escape="", header=True).csv(path))
    return path


@query
def src_tsv_reordered(spark, sf_dir):
    return tsv.read_tsv(spark, _ratings_lines(spark, sf_dir, False), "title_ratings")


@query
def src_tsv_bad_rows(spark, sf_dir):
    return tsv.scan_tsv(spark, _ratings_lines(spark, sf_dir, True), "title_ratings")


@query
def src_tsv_drop_bad(spark, sf_dir):
    return tsv.read_tsv(spark, _ratings_lines(spark, sf_dir, True), "title_ratings", bad_rows="drop")


@query
def src_na_tokens(spark, sf_dir):
    return bindings.bronze(spark, sf_dir, "name_basics")


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = sinks.write_table(_m(spark, sf_dir).stg_ratings,
                             scratch_path(spark, "stg_ratings_zstd"), compression="zstd")
    return spark.read.parquet(path)


@query
def sink_mode_overwrite(spark, sf_dir):
    df = _m(spark, sf_dir).stg_ratings
    path = scratch_path(spark, "stg_ratings_overwrite")
    sinks.write_table(df, path, mode="truncate")
    sinks.write_table(df, path, mode="truncate")
    return spark.read.parquet(path)


@query
def sink_mode_append(spark, sf_dir):
    df = _m(spark, sf_dir).stg_ratings
    path = scratch_path(spark, "stg_ratings_append")
    sinks.write_table(df, path, mode="empty")
    sinks.write_table(df, path, mode="append")
    return spark.read.parquet(path)


@query
def bronze_refresh_report(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    sources = {}
    for name in bindings.BOUND_TABLES:
        sources[name] = tsv.write_tsv(bindings.raw_bronze(spark, sf_dir, name),
                                      f"{landing}/{name}.tsv.gz")
    from marquee.sources.refresh import refresh_bronze
    report = refresh_bronze(spark, sources, scratch_path(spark, "bronze"), parallel_tables=3)
    return report.select("table_name", "ok", "skipped", "rows", "error")


@query
def bronze_refresh_states(spark, sf_dir):
    """First load, a repeat, a forced repeat, changed files and changed options, with a source that is not there."""
    from marquee.schemas import STRICT_NA_TOKENS
    from marquee.sources.refresh import refresh_bronze
    episodes = scratch_path(spark, "landing")
    tsv.write_tsv(bindings.raw_bronze(spark, sf_dir, "title_episode"), f"{episodes}/day=1")
    sources = {"title_episode": episodes, "title_ratings": _ratings_lines(spark, sf_dir, True),
               "title_akas": f"{episodes}-missing"}
    target = scratch_path(spark, "bronze")
    steps = []

    def step(name, **how):
        report = refresh_bronze(spark, sources, target, **how)
        steps.append(report.select(F.lit(name).alias("step"), "table_name", "ok", "skipped", "forced", "rows",
                                   "bad_rows", "null_values", F.col("error").isNotNull().alias("failed")))
    step("first")
    step("again")
    step("forced", force=True)
    tsv.write_tsv(bindings.raw_bronze(spark, sf_dir, "title_episode").limit(0), f"{episodes}/day=2")
    step("nested file added")
    step("other tokens", na_tokens=STRICT_NA_TOKENS)
    return reduce(DataFrame.unionByName, steps)


def _partitioned_movies(spark, sf_dir):
    path = scratch_path(spark, "movies_by_decade")
    sinks.write_movies_partitioned(_m(spark, sf_dir).movies, path)
    return path


@query
def sink_range_partitioned(spark, sf_dir):
    path = _partitioned_movies(spark, sf_dir)
    return (spark.read.parquet(path)
            .select(*marts.MOVIE_FLAT_COLS,
                    F.col("release_decade").cast("bigint").alias("release_decade")))


@query
def scan_pruned_decade(spark, sf_dir):
    path = _partitioned_movies(spark, sf_dir)
    return sinks.movies_between(spark, path, DECADE, DECADE + 9).select(*marts.MOVIE_FLAT_COLS)


@query
def sink_csv_roundtrip(spark, sf_dir):
    top = q_top_rated(spark, sf_dir)
    path = sinks.export_csv(top, scratch_path(spark, "top_rated_csv"), single_file=True)
    return sinks.read_csv(spark, path, top.schema)


@query
def sink_csv_ordered(spark, sf_dir):
    """The flat fact by votes, written as eight CSV files in one order and read back with places."""
    m = _mart(spark, sf_dir, "movies").select("movie_id", "num_votes", "average_rating")
    path = sinks.export_csv_ordered(m, scratch_path(spark, "movies_csv"),
                                    [F.desc("num_votes"), F.asc("movie_id")], num_files=8)
    return sinks.read_csv_ordered(spark, path, m.schema).drop("file")


# ---------------------------------------------------------------- usage (K1-K5)
def _records(spark, sf_dir):
    return usage.usage_records(read_driver(spark, sf_dir, "conversations"))


@query
def usage_summary(spark, sf_dir):
    return usage.session_summary(_records(spark, sf_dir))


@query
def usage_by_model(spark, sf_dir):
    return usage.uses_by_model(_records(spark, sf_dir))


@query
def usage_session_duration(spark, sf_dir):
    return usage.session_duration(read_driver(spark, sf_dir, "events"))


@query
def usage_token_estimate(spark, sf_dir):
    return usage.token_estimates(read_driver(spark, sf_dir, "conversations"))


@query
def usage_display(spark, sf_dir):
    return usage.display_totals(_records(spark, sf_dir))


@query
def usage_history_stream(spark, sf_dir):
    """Usage records landed as files in two drops, appended by the stream."""
    from marquee.streaming import stream_history
    records = _records(spark, sf_dir)
    landing = scratch_path(spark, "usage-landing")
    history = scratch_path(spark, "usage-history")
    ckpt = scratch_path(spark, "usage-history-ckpt")
    records.filter(F.col("turn") % 2 == 0).write.mode("append").parquet(landing)
    stream_history(spark, landing, history, ckpt)
    records.filter(F.col("turn") % 2 == 1).write.mode("append").parquet(landing)
    stream_history(spark, landing, history, ckpt)   # resumes: only the new drop
    return spark.read.parquet(history)


@query
def usage_model_counts_stream(spark, sf_dir):
    """Per-model counter kept as streaming state over the landed records."""
    from marquee.streaming import read_published, stream_model_counts
    landing = scratch_path(spark, "usage-landing")
    counts = scratch_path(spark, "usage-counts")
    _records(spark, sf_dir).write.mode("append").parquet(landing)
    stream_model_counts(spark, landing, counts)
    return read_published(spark, counts)


def _questions(spark, sf_dir):
    return usage.question_records(bindings.usage_log(spark, sf_dir))


def _plain_time(records):
    return records.select("conv_id", "question_no", F.unix_micros("timestamp").alias("asked_us"), "question",
                          "model", "input_tokens", "output_tokens", "sql_executed")


@query
def usage_questions(spark, sf_dir):
    """One usage record per question."""
    return _plain_time(_questions(spark, sf_dir))


@query
def usage_question_summary(spark, sf_dir):
    """Sessions from question records alone: questions, tokens, time and uses of each model."""
    return usage.question_summary(_questions(spark, sf_dir))


@query
def usage_question_history(spark, sf_dir):
    """Question records landed in two drops, appended by the stream."""
    from marquee.streaming import QUESTION_RECORD_SCHEMA, stream_history
    records = _questions(spark, sf_dir)
    landing, history, ckpt = (scratch_path(spark, f"question-{x}") for x in ("landing", "history", "ckpt"))
    for part in (0, 1):
        records.filter(F.col("question_no") % 2 == part).write.mode("append").parquet(landing)
        stream_history(spark, landing, history, ckpt, schema=QUESTION_RECORD_SCHEMA)
    return _plain_time(spark.read.schema(QUESTION_RECORD_SCHEMA).parquet(history))


@query
def usage_published_counts(spark, sf_dir):
    """Uses of each model, published per batch of two drops, then pruned to the last version."""
    from marquee.streaming import QUESTION_RECORD_SCHEMA, prune_versions, read_published, stream_model_counts
    records = _questions(spark, sf_dir)
    landing, counts, ckpt = (scratch_path(spark, f"question-{x}") for x in ("landing", "counts", "counts-ckpt"))
    for part in (0, 1):
        records.filter(F.col("question_no") % 2 == part).write.mode("append").parquet(landing)
        stream_model_counts(spark, landing, counts, ckpt, schema=QUESTION_RECORD_SCHEMA)
    prune_versions(spark, counts, keep=1)
    return read_published(spark, counts)
