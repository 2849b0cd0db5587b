"""Full build: bronze tables on disk -> marts written as tables."""

import os

from conftest import SF001

from marquee.plans.pipeline import FIXED_AS_OF, Params, build, models_from_fixtures, models_from_tables
from marquee.sources import bindings, tsv
from marquee.sources.refresh import refresh_bronze


def test_refresh_then_build(spark, tmp_out):
    landing = os.path.join(tmp_out, "landing")
    sources = {n: tsv.write_tsv(bindings.raw_bronze(spark, SF001, n), os.path.join(landing, n))
               for n in bindings.BOUND_TABLES}
    rep = refresh_bronze(spark, sources, os.path.join(tmp_out, "bronze"))
    assert rep.filter("ok").count() == len(bindings.BOUND_TABLES) == 7
    m = models_from_tables(spark, os.path.join(tmp_out, "bronze"), Params(as_of=FIXED_AS_OF))
    out = build(m, os.path.join(tmp_out, "silver"))
    assert set(out) == {"movies", "dim_directors", "dim_actors"}
    direct = models_from_fixtures(spark, SF001)
    assert spark.read.parquet(out["movies"]).count() == 83
    for name in ("dim_directors", "dim_actors"):
        written = spark.read.parquet(out[name])
        want = getattr(direct, name)
        assert written.count() == want.count()
        assert written.exceptAll(want.select(*written.columns)).count() == 0
