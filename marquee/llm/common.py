"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.session import scratch_path

#: Spark deletes a query's shuffle files at its end
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package by the path the driver uses.

    A cluster that installs the package on its nodes needs nothing; the extra
    path entry is then simply not found.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, _ROOT])


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` under the shared scratch root and read it back.

    Cuts the lineage with a table all executors can read, so losing an
    executor later does not recompute (or lose) it.  The query's shuffle files
    go when the table is written: nothing else reads them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.option("compression", codec) if codec else df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        w.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialise`, when nothing reads it any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in {os.path.dirname(f) for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them when the
    driver has collected the plans that wrote them, which else may take long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def iter_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Yield one table per run of equal ``key`` values in sorted batches."""
    import numpy as np
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(key))
        n = b.num_rows
        if n > 1:
            differs = pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(differs) + 1).tolist()
        else:
            cuts = []
        edges = [0, *cuts, n]
        for lo, hi in zip(edges[:-1], edges[1:]):
            k = col[lo].as_py()
            if held and k != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = k
    if held:
        yield pa.Table.from_batches(held)
