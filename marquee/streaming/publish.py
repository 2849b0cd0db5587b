"""Small tables published in whole versions.

Each version is a folder of its own.  It counts once its marker, an empty
file, stands in ``_commits``; creating a file is atomic on every store, so a
reader sees the last whole version and never a folder that is being written.
Publishing a version again does nothing, and one that failed half-way is
written anew.  Versions are batch numbers of one writer (one checkpoint).
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(version, writer) of every published version, the oldest first."""
    p, fs = _fs(spark, f"{table.rstrip('/')}/_commits")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted((int(v), w) for v, _, w in (n.partition("-") for n in names) if v.isdigit())


def versions(spark: SparkSession, table: str) -> list[int]:
    return [v for v, _ in _commits(spark, table)]


def publish(df: DataFrame, table: str, version: int, writer: str = "") -> bool:
    """Write ``df`` as ``version`` unless that or a later one stands; whether it was written.

    ``writer`` names who numbers the versions; a table holds those of one writer.
    """
    spark, root = df.sparkSession, table.rstrip("/")
    mark = f"{zlib.crc32(writer.encode()):08x}"
    done = _commits(spark, root)
    if any(w != mark for _, w in done):
        raise ValueError(f"{table} holds versions of another writer")
    if done and done[-1][0] >= version:
        return False
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    p, fs = _fs(spark, f"{root}/_commits/{version}-{mark}")
    fs.create(p, False).close()
    return True


def read_published(spark: SparkSession, table: str) -> DataFrame:
    """The last published version."""
    done = versions(spark, table)
    if not done:
        raise FileNotFoundError(f"{table}: nothing published")
    return spark.read.parquet(f"{table.rstrip('/')}/version={done[-1]}")


def prune_versions(spark: SparkSession, table: str, keep: int = 5) -> int:
    """Delete all but the last ``keep`` versions (at least one); readers may hold the kept ones."""
    old = _commits(spark, table)[:-max(keep, 1)]
    for v, mark in old:
        # the marker last, so that a version with a folder is still known
        for name in (f"version={v}", f"_commits/{v}-{mark}"):
            p, fs = _fs(spark, f"{table.rstrip('/')}/{name}")
            fs.delete(p, True)
    return len(old)
