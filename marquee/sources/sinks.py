"""Sinks: Parquet tables with load modes, the range-partitioned fact table,
its pruned scan, and CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMPRESSIONS = ("snappy", "gzip", "zstd", "lz4", "none", "uncompressed")

# Load dispositions of the bronze loader -> DataFrameWriter save modes.
MODES = {
    "truncate": "overwrite", "write_truncate": "overwrite", "overwrite": "overwrite",
    "append": "append", "write_append": "append",
    "empty": "errorifexists", "write_empty": "errorifexists", "errorifexists": "errorifexists",
}

# Integer range partitioning of the fact table by release year,
# start 1950, end 2030 (exclusive), interval 10; years outside go to NULL.
DECADE_START, DECADE_END, DECADE_STEP = 1950, 2030, 10


def write_table(df: DataFrame, path: str, mode: str = "truncate",
                compression: str = "snappy", partition_by=None,
                max_records_per_file: int | None = None) -> str:
    """Write Parquet with a load disposition (truncate / append / empty)."""
    c = compression.lower()
    if c == "brotli":
        raise ValueError("brotli is not available to the Parquet writer here; "
                         "use snappy, gzip or zstd")
    if c not in COMPRESSIONS:
        raise ValueError(f"unknown compression {compression!r}")
    m = MODES.get(mode.lower())
    if m is None:
        raise ValueError(f"unknown write mode {mode!r}")
    w = df.write.mode(m).option("compression", c)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def release_decade(year_col: str = "release_year") -> F.Column:
    y = F.col(year_col)
    return F.when((y >= DECADE_START) & (y < DECADE_END),
                  (F.floor((y - DECADE_START) / DECADE_STEP) * DECADE_STEP + DECADE_START)
                  .cast("int"))


def write_movies_partitioned(movies: DataFrame, path: str, mode: str = "truncate",
                             num_partitions: int | None = None) -> str:
    """Fact table partitioned by release decade and clustered by ``num_votes``.

    Range-partitioning on (decade, votes) gives each task a contiguous slice
    (a large decade is split over several tasks, so no task holds a whole
    decade) and files whose votes ranges barely overlap; sorting by votes
    inside the task tightens the Parquet min/max statistics for votes filters.
    """
    return write_table(clustered_movies(movies, num_partitions), path, mode,
                       partition_by="release_decade")


def clustered_movies(movies: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``movies`` with ``release_decade``, range-partitioned and sorted for the partitioned table."""
    keyed = movies.withColumn("release_decade", release_decade())
    # without an explicit count AQE sizes the range partitions from the data
    # (advisory partition size), so small tables do not write hundreds of files
    ranged = (keyed.repartitionByRange(num_partitions, "release_decade", "num_votes")
              if num_partitions else keyed.repartitionByRange("release_decade", "num_votes"))
    return ranged.sortWithinPartitions("release_decade", "num_votes")


def decade_filter(df: DataFrame, lo_year: int, hi_year: int) -> DataFrame:
    """``release_year BETWEEN lo AND hi``; on the partitioned table also the
    implied ``release_decade`` predicate, which Spark does not derive itself,
    so only the matching partitions are listed and read."""
    out = df.filter(F.col("release_year").between(lo_year, hi_year))
    if "release_decade" in df.columns:
        lo_dec = max(DECADE_START, lo_year - (lo_year - DECADE_START) % DECADE_STEP)
        if lo_year < DECADE_START or hi_year >= DECADE_END:
            # years outside the range live in the NULL partition
            out = out.filter(F.col("release_decade").isNull()
                             | F.col("release_decade").between(lo_dec, hi_year))
        else:
            out = out.filter(F.col("release_decade").between(lo_dec, hi_year))
    return out


def movies_between(spark: SparkSession, path: str, lo_year: int, hi_year: int) -> DataFrame:
    """Partition-pruned scan of the written fact table."""
    return decade_filter(spark.read.parquet(path), lo_year, hi_year)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header row.  ``single_file`` is for small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_csv_ordered(df: DataFrame, path: str, order, num_files: int | None = None) -> str:
    """CSV in one global order over many files, each with a header row.

    Rows are range-partitioned by ``order`` and sorted within their file, so
    the files' names (``part-00000-...``, ``part-00001-...``) follow the order
    and every file is written by a task of its own.  Without ``num_files``
    adaptive execution sizes the files.  Rows equal in ``order`` stay together.
    """
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    ranged = (df.repartitionByRange(num_files, *order) if num_files else df.repartitionByRange(*order))
    ranged.sortWithinPartitions(*order).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv_ordered(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a CSV export with ``file`` (its name) and ``row_no``, the place (from 1) over all files.

    Places within a file are a window over that file; files are added up by
    a prefix sum over one row per file.
    """
    rows = (read_csv(spark, path, schema)
            .select("*", F.col("_metadata.file_name").alias("file"),
                    F.col("_metadata.file_block_start").alias("_block"))
            .withColumn("_id", F.monotonically_increasing_id()))
    in_file = Window.partitionBy("file").orderBy("_block", "_id")
    placed = rows.withColumn("_in", F.row_number().over(in_file))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # the counts need no place: they come from a scan without the rows' columns
    files = (read_csv(spark, path, schema).select(F.col("_metadata.file_name").alias("file"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
             .select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return placed.join(files, "file").withColumn("row_no", F.col("_before") + F.col("_in")) \
        .drop("_block", "_id", "_in", "_before")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
