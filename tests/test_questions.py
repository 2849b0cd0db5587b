"""Question set on a small hand-written catalogue."""

import pytest
from helpers import N, credit, models, person, title

from marquee.plans import questions


@pytest.fixture(scope="module")
def m(spark):
    titles = [title("tt1", "1994", genres="Drama,Sci-Fi"), title("tt2", "1996", genres="Drama"),
              title("tt3", "2012", genres="Sci-Fi"), title("tt4", "2015", genres=N)]
    ratings = [("tt1", 9.1, 50000), ("tt2", 7.0, 60000), ("tt3", 9.5, 20000), ("tt4", 9.5, 30000)]
    people = [person("nm1", "Ann Lee"), person("nm2", "Bob Ray"), person("nm3", "Cy Nolan"),
              person("nm4", "Di Nolan")]
    crew = [("tt1", "nm3", N), ("tt2", "nm3,nm4", N), ("tt3", "nm4", N), ("tt4", N, N)]
    pr = [credit("tt1", 1, "nm1"), credit("tt1", 2, "nm2", "actress"),
          credit("tt2", 1, "nm1"), credit("tt3", 1, "nm2", "actress")]
    return models(spark, titles, ratings, people, crew, pr)


def _ids(df):
    return [r.movie_id for r in df.collect()]


def test_rankings(m):
    assert _ids(questions.top_rated(m.movies, 2)) == ["tt4", "tt3"]       # votes break the tie
    assert _ids(questions.genre_top(m.movies, "Sci-Fi")) == ["tt3", "tt1"]
    assert _ids(questions.best_of_decade(m.movies, 1990)) == ["tt1", "tt2"]
    assert _ids(questions.rating_and_decade(m.movies, 9.0, 2010)) == ["tt4", "tt3"]


def test_people_questions(m):
    assert _ids(questions.movies_by_director_like(m.movies, "%Nolan%")) == ["tt3", "tt1", "tt2"]
    assert _ids(questions.filmography(m.movies, "Cy Nolan")) == ["tt1", "tt2"]
    assert _ids(questions.movies_by_actor(m.movies, "Ann Lee")) == ["tt1", "tt2"]
    assert _ids(questions.collaboration(m.movies, "Bob%", "Di%")) == ["tt3"]
    got = {r.actor_id: r.movies_together
           for r in questions.actors_with_director(m.movies, "Cy%").collect()}
    assert got == {"nm1": 2, "nm2": 1}
    top = questions.directors_most_movies(m.movies, 1).first()
    assert (top.director_id, top.movies) == ("nm3", 2)          # tie with nm4 -> id order


def test_gender_by_decade_and_sql(spark, m):
    g = {(r.decade, r.gender): (r.credits, r.actors)
         for r in questions.gender_by_decade(m.movies).collect()}
    assert g == {(1990, "Male"): (2, 1), (1990, "Female"): (1, 1), (2010, "Female"): (1, 1)}
    out = questions.sql_surface(spark, {"movies": m.movies},
                                "SELECT count(*) AS n FROM {movies} WHERE exists(directors, d -> d.name LIKE '%Nolan')")
    assert out.first().n == 3
