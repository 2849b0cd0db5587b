"""Connected components of an edge table by alternating star contraction.

Each round is two group-and-join passes over the edges: the large star links
every larger neighbour of a vertex to the vertex's smallest neighbour, the
small star links the smaller ones.  The number of rounds is logarithmic in
practice; each round's edges are written to the shared scratch root, so no
lineage grows and a lost executor costs one stage.  Only counts reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import drop_table, materialise


def _towards_min(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): (u, v, m) with m the smallest of u and all its v."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(low, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    p = _towards_min(both).filter(F.col("v") > F.col("u"))
    return p.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    p = _towards_min(down)
    out = p.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        p.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (u, v) of any orderable type -> (node, root), root = smallest vertex.

    Vertices without an edge do not appear; null ends and loops are ignored.
    """
    spark = edges.sparkSession
    cur = materialise(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "cc-edges")
    seen = None
    while True:
        mark = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        nxt = materialise(_small_star(_large_star(cur)), "cc-edges")
        drop_table(spark, cur)
        cur = nxt
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
