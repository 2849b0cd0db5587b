"""Tiny bronze catalogues written by hand for rule-level tests."""

from conftest import bronze_df

from marquee.plans.pipeline import Models, Params

N = "\\N"


def title(tconst, year="2000", kind="movie", adult=0, primary=None, genres="Drama"):
    return (tconst, kind, primary if primary is not None else f"T{tconst}", f"T{tconst}",
            adult, year, N, "100", genres)


def person(nconst, name=None, birth="1960", death=N, known="tt0000001", prof="actor"):
    return (nconst, name if name is not None else f"P{nconst}", birth, death, prof, known)


def credit(tconst, ordering, nconst, category="actor"):
    return (tconst, ordering, nconst, category, None, '["x"]')


def models(spark, titles, ratings, people, crew, principals, **params):
    b = {
        "title_basics": bronze_df(spark, "title_basics", titles),
        "title_ratings": bronze_df(spark, "title_ratings", ratings),
        "name_basics": bronze_df(spark, "name_basics", people),
        "title_crew": bronze_df(spark, "title_crew", crew),
        "title_principals": bronze_df(spark, "title_principals", principals),
    }
    params.setdefault("as_of", "2026-01-01")
    return Models(b, Params(**params))
