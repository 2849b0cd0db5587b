"""Hot keys: salted joins and large groups built from runs."""

from collections import Counter

from pyspark.sql import functions as F

from marquee.operators.nest import nest_in_runs, nest_ordered
from marquee.operators.skew import hot_keys, salted_left_join


def _credits(spark, n=20_000):
    # half of the rows belong to one person, some to nobody
    person = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 97 == 0, None) \
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 500).cast("string")))
    return spark.range(n).select(F.col("id").alias("credit"), person.alias("who"))


def _people(spark):
    return spark.createDataFrame([("hot", "H")] + [(f"p{i}", f"P{i}") for i in range(0, 400)], "person string, name string")


def test_hot_keys(spark):
    assert hot_keys(_credits(spark), "who", share=0.1) == ["hot"]
    assert hot_keys(_credits(spark).filter("false"), "who") == []


def test_salted_join_equals_plain_join(spark):
    c, p = _credits(spark), _people(spark)
    plain = c.join(p, F.col("who") == F.col("person"), "left")
    twice = p.unionByName(spark.createDataFrame([("hot", "H2")], p.schema))   # a repeated key on the right
    for right, want in ((p, plain), (twice, c.join(twice, F.col("who") == F.col("person"), "left"))):
        got = salted_left_join(c, right, "who", "person", ["hot"], ["credit"], salts=8)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert salted_left_join(c, p, "who", "person", [], ["credit"]).count() == plain.count()


def test_salted_join_spreads_the_hot_key(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "-1", "16")):
            spark.conf.set(k, v)

        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        c, p = _credits(spark), _people(spark)
        plain = largest(c.join(p, F.col("who") == F.col("person"), "left"))
        salted = largest(salted_left_join(c, p, "who", "person", ["hot"], ["credit"], salts=64))
        assert plain > 10_000 and salted < 4_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_runs_equal_the_plain_nest(spark):
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 30 == 0, None)
         .otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias("title"),
        F.concat(F.lit("n"), F.pmod(F.xxhash64("id"), F.lit(50)).cast("string")).alias("name"), "id")
    fields = [F.col("id").alias("id"), F.col("name").alias("name")]
    want = {r.title: r.a for r in nest_ordered(rows, "title", ["name", "id"], fields, "a").collect()}
    for run_rows in (7, 500, 100_000):
        got = nest_in_runs(rows, "title", ["name", "id"], fields, "a", run_rows).collect()
        assert len(got) == len(want) and {r.title: r.a for r in got} == want
