from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions import band, exact_mean, human_count, rounded_share, token_estimate
from marquee.functions.scalar import RATING_CATEGORY, age, decade, safe_int, trim_ws


def test_band_ladder_and_null(spark):
    df = spark.createDataFrame([(8.5,), (8.49,), (5.5,), (1.0,), (None,)], "x double")
    got = [r[0] for r in df.select(band("x", *RATING_CATEGORY)).collect()]
    assert got == ["Excellent", "Very Good", "Average", "Below Average", "Below Average"]


def test_exact_mean_half_up(spark):
    # 7.0, 7.0, 7.0, 7.1 -> 7.025 exactly -> 7.03 (a float mean may print 7.02)
    df = spark.createDataFrame([(Decimal("28.1"), 4), (Decimal("4.0"), 3)],
                               "s decimal(20,8), n bigint")
    got = [r[0] for r in df.select(exact_mean(F.col("s"), F.col("n"))).collect()]
    assert got == [7.03, 1.33]


def test_rounded_share(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5)], "p bigint, w bigint")
    got = [r[0] for r in df.select(rounded_share(F.col("p"), F.col("w"))).collect()]
    assert got == [33.3, 66.7, 12.5, 0.0]


def test_human_count(spark):
    vals = [0, 999, 1000, 1001, 1250, 1049, 999999, 1000000, 1000001, 1234567, 1005000]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    got = [r[0] for r in df.select(human_count("n")).collect()]
    assert got == ["0", "999", "1000", "1.0K", "1.2K", "1.0K", "1000.0K", "1000.0K",
                   "1.00M", "1.23M", "1.00M"]


def test_scalars(spark):
    df = spark.createDataFrame([(" \t12\n", "abcdefgh", 1994, 1930, None)],
                               "s string, t string, y int, b int, d int")
    r = df.select(trim_ws("s"), safe_int(trim_ws("s")), safe_int(F.lit("1994.0")),
                  token_estimate("t"), decade("y"), age("b", "d", "2026-06-30")).first()
    assert tuple(r) == ("12", 12, None, 2, 1990, 96)


def test_cluster_conf_scales_partitions():
    from marquee.session import cluster_conf
    small, big = cluster_conf(16), cluster_conf(8000)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "24000"
    assert big["spark.sql.adaptive.skewJoin.skewedPartitionFactor"] == "5"
