"""Staging rules: strict thresholds, tolerant casts, NULL tokens, trimming."""

from conftest import bronze_df
from helpers import N, credit, models, person, title

from marquee.plans import staging
from marquee.schemas import STRICT_NA_TOKENS


def _ids(df, col):
    return sorted(r[0] for r in df.select(col).collect())


def test_thresholds_are_strict(spark):
    t = bronze_df(spark, "title_basics", [
        title("tt1", year="1950"), title("tt2", year="1951"), title("tt3", year=N)])
    assert _ids(staging.stg_title_basics(t), "movie_id") == ["tt2"]
    assert _ids(staging.stg_title_basics(t, min_year=1949), "movie_id") == ["tt1", "tt2"]
    r = bronze_df(spark, "title_ratings", [("tt1", 7.0, 10000), ("tt2", 7.0, 10001),
                                           ("tt3", 11.0, 50000), ("tt4", None, 50000)])
    assert _ids(staging.stg_ratings(r), "movie_id") == ["tt2"]
    assert _ids(staging.stg_ratings(r, min_votes=9999), "movie_id") == ["tt1", "tt2"]


def test_title_filters(spark):
    t = bronze_df(spark, "title_basics", [
        title("tt1"), title("tt2", kind="short"), title("tt3", adult=1),
        title("tt4", primary=""), title("tt5", year="1994.0"), title("tt6", year="abc")])
    # non-integer year text fails the tolerant cast and the year filter
    assert _ids(staging.stg_title_basics(t), "movie_id") == ["tt1"]


def test_none_title_follows_token_list(spark):
    from marquee.schemas import BRONZE_SCHEMAS
    from marquee.sources.tsv import normalize_na
    raw = spark.createDataFrame([title("tt1", primary="None"), title("tt2", primary="Up")],
                                BRONZE_SCHEMAS["title_basics"])
    default = staging.stg_title_basics(normalize_na(raw))
    strict = staging.stg_title_basics(normalize_na(raw, STRICT_NA_TOKENS))
    assert _ids(default, "movie_id") == ["tt2"]          # pandas NA list: "None" is NULL
    assert _ids(strict, "movie_id") == ["tt1", "tt2"]    # only \N is NULL


def test_person_filters(spark):
    p = bronze_df(spark, "name_basics", [
        person("nm1"), person("nm2", birth="1799"), person("nm3", birth="2021"),
        person("nm4", birth=N), person("nm5", known=""), person("nm6", name=""),
        person("nm7", birth="1800", death="1870"), person("nm8", birth="2020")])
    out = staging.stg_person(p)
    assert _ids(out, "person_id") == ["nm1", "nm7", "nm8"]
    row = out.filter("person_id = 'nm7'").first()
    assert (row.birth_year, row.death_year) == (1800, 1870)


def test_crew_split_trim_and_orphans(spark):
    crew = bronze_df(spark, "title_crew", [
        ("tt1", "nm1, nm2,\tnm3 ,,", N), ("tt2", N, N), ("tt3", "", N)])
    ppl = staging.stg_person(bronze_df(spark, "name_basics", [person("nm1"), person("nm3")]))
    out = staging.stg_crew(crew, ppl)
    rows = sorted((r.movie_id, r.director_id, r.director_name) for r in out.collect())
    assert rows == [("tt1", "nm1", "Pnm1"), ("tt1", "nm2", None), ("tt1", "nm3", "Pnm3")]


def test_actor_gender_and_left_join(spark):
    m = models(spark, [], [], [person("nm1")], [],
               [credit("tt1", 1, "nm1", "actor"), credit("tt1", 2, "nm2", "actress"),
                credit("tt1", 3, "nm1", "director")])
    rows = sorted((r.ordering, r.actor_id, r.gender, r.actor_name)
                  for r in m.stg_actor.collect())
    assert rows == [(1, "nm1", "Male", "Pnm1"), (2, "nm2", "Female", None)]
