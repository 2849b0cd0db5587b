"""Fact and dimension rules on a hand-written catalogue.

tt01: 12 credits, one by an unknown person -> top 10 of the 11 known ones.
tt02: nm02 credited twice, nm01 credited as actress.
tt03: ties tt01 on rating and votes (best-movie tie-break by id).
tt04: no people at all -> NULL arrays and NULL counts.
"""

import pytest
from helpers import N, credit, models, person, title

from marquee.plans import marts


@pytest.fixture(scope="module")
def m(spark):
    titles = [title("tt01", "2001"), title("tt02", "2005"), title("tt03", "2010"),
              title("tt04", "2012")]
    ratings = [("tt01", 8.0, 20000), ("tt02", 6.0, 30000), ("tt03", 8.0, 20000),
               ("tt04", 9.0, 50000)]
    people = [person(f"nm{i:02d}") for i in range(1, 13)]
    people.append(person("nm13", birth="1900", death="1980"))
    crew = [("tt01", "nm13,nm12", N), ("tt02", "nm12", N), ("tt03", "nm98", N), ("tt04", N, N)]
    pr = [credit("tt01", 1, "nm01"), credit("tt01", 2, "nm99")]
    pr += [credit("tt01", i + 1, f"nm{i:02d}") for i in range(2, 12)]
    pr += [credit("tt02", 1, "nm02"), credit("tt02", 2, "nm02"),
           credit("tt02", 3, "nm01", "actress"),
           credit("tt03", 1, "nm03"), credit("tt03", 2, "nm01")]
    return models(spark, titles, ratings, people, crew, pr)


def test_movies_arrays_and_counts(m):
    rows = {r.movie_id: r for r in m.movies.collect()}
    assert sorted(rows) == ["tt01", "tt02", "tt03", "tt04"]
    a1 = [a.id for a in rows["tt01"].actors]
    assert a1 == ["nm01"] + [f"nm{i:02d}" for i in range(2, 11)]   # nm99 skipped, nm11 cut
    assert rows["tt01"].actor_count == 10
    assert [d.id for d in rows["tt01"].directors] == ["nm12", "nm13"]  # by name
    assert [a.id for a in rows["tt02"].actors] == ["nm02", "nm02", "nm01"]
    assert rows["tt03"].directors is None and rows["tt03"].director_count is None
    assert rows["tt04"].actors is None and rows["tt04"].actor_count is None
    assert rows["tt01"].rating_category == "Very Good"
    assert rows["tt04"].rating_category == "Excellent"


def test_dim_actors_rules(m):
    d = {(r.actor_id, r.gender): r for r in m.dim_actors.collect()}
    # two genders -> two rows with identical statistics
    assert ("nm01", "Male") in d and ("nm01", "Female") in d
    a, b = d[("nm01", "Male")], d[("nm01", "Female")]
    assert a.total_movies == b.total_movies == 3
    assert a.avg_movie_rating == 7.33
    assert a.total_votes == 70000
    assert a.best_movie_id == "tt01"           # tie with tt03 broken by id
    assert (a.lead_role_count, a.lead_role_percentage, a.role_type) == (1, 33.3, "Mixed Roles")
    # credited twice in tt02: counts once as a movie, twice in means and sums
    n2 = d[("nm02", "Male")]
    assert n2.total_movies == 2 and n2.total_votes == 80000 and n2.avg_movie_rating == 6.67
    assert (n2.lead_role_count, n2.lead_role_percentage) == (2, 66.7)
    assert n2.role_type == "Leading Actor"
    assert ("nm11", "Male") not in d and not any(k[0] == "nm99" for k in d)
    assert a.age == 2026 - 1960


def test_lead_position_parameter(spark, m):
    top = marts.dim_actors(m.movies, m.stg_person, "2026-01-01", lead_position=0)
    r = top.filter("actor_id = 'nm02'").first()
    assert (r.lead_role_count, r.lead_role_percentage) == (1, 33.3)


def test_dim_directors(m):
    d = {r.director_id: r for r in m.dim_directors.collect()}
    assert sorted(d) == ["nm12", "nm13"]
    assert (d["nm12"].total_movies, d["nm12"].avg_movie_rating) == (2, 7.0)
    assert d["nm12"].best_movie_id == "tt01" and d["nm12"].career_span_years == 4
    assert d["nm13"].age == 80
    assert d["nm12"].director_tier == "Excellent" and d["nm12"].career_stage == "New"


def test_flatten_round_trip(m):
    flat = marts.movies_actors(m.movies)
    got = sorted((r.movie_id, r.pos, r.actor_id) for r in flat.collect())
    assert ("tt02", 1, "nm02") in got and len([g for g in got if g[0] == "tt01"]) == 10
    assert sorted(r.pos for r in flat.filter("movie_id = 'tt01'").collect()) == list(range(10))
