"""Bronze refresh: source files -> typed Parquet tables, with a report.

Each table is one Spark job (scan -> NULL tokens -> write) whose row counts
are observed while it writes.  A manifest beside each table lists the source
files it was loaded from and the load options; a table is skipped when
neither has changed, unless ``force`` is set.  Failures are reported per
table instead of stopping the run unless ``fail_fast`` is set.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import BRONZE_SCHEMAS, DEFAULT_NA_TOKENS
from marquee.session import exists
from marquee.sources.sinks import write_table
from marquee.sources.tsv import checked, scan_tsv, source_files

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("skipped", T.BooleanType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("forced", T.BooleanType()),
    T.StructField("bad_rows", T.LongType()),
    T.StructField("null_values", T.LongType()),
])
COUNTS = ("rows", "bad_rows", "null_values")
FILE = ("path", "length", "modified", "options")


def _manifest(target: str) -> str:
    return target.rstrip("/") + ".manifest"


def load_options(table: str, na_tokens=None, compression: str = "snappy", mode: str = "truncate",
                 bad_rows: str = "null") -> str:
    """What besides the files decides the loaded rows, as text."""
    tokens = sorted(DEFAULT_NA_TOKENS if na_tokens is None else na_tokens)
    schema = BRONZE_SCHEMAS[table].simpleString() if table in BRONZE_SCHEMAS else ""
    return json.dumps([schema, tokens, compression, mode, bad_rows])


def is_fresh(spark: SparkSession, source: str, target: str, options: str = "") -> bool:
    """True when ``target`` was loaded from exactly the present files of ``source``
    (path, size and time, nested ones too) with the same options."""
    if not (exists(spark, target.rstrip("/") + "/_SUCCESS") and exists(spark, _manifest(target) + "/_SUCCESS")):
        return False
    old = spark.read.parquet(_manifest(target)).select(*FILE)
    now = source_files(spark, source).withColumn("options", F.lit(options))
    return (now.join(old, list(FILE), "left_anti").isEmpty()
            and old.join(now, list(FILE), "left_anti").isEmpty())


def skip_if_fresh(spark: SparkSession, source: str, target: str, force: bool = False, options: str = "") -> bool:
    """True when the load of ``source`` into ``target`` can be skipped."""
    return not force and is_fresh(spark, source, target, options)


def table_path(root: str, dotted_name: str) -> str:
    """Target path of a source file's table: ``title.basics`` -> ``<root>/title_basics``."""
    from marquee.schemas import table_id
    return f"{root.rstrip('/')}/{table_id(dotted_name)}"


def load_table(spark: SparkSession, name: str, source: str, target: str, na_tokens=None,
               mode: str = "truncate", compression: str = "snappy", bad_rows: str = "null") -> dict[str, int]:
    """Load one table and write its manifest; returns the counts observed during the write.

    The manifest goes first and comes last: a load that ends in between
    leaves none, and is done again.
    """
    options = load_options(name, na_tokens, compression, mode, bad_rows)
    files = source_files(spark, source)  # as listed before the load
    if mode != "append":
        _delete(spark, _manifest(target))
    rows = scan_tsv(spark, source, name, na_tokens, min_partitions=spark.sparkContext.defaultParallelism)
    seen = Observation(f"load-{name}")
    columns = [c for c in rows.columns if c != "bad_row"]
    kept = checked(rows, bad_rows)
    nulls = sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0))
    kept = (rows if bad_rows == "drop" else kept).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("bad_row").isNotNull()).alias("bad_rows"),
        F.coalesce(F.sum(nulls if bad_rows != "drop" else F.when(F.col("bad_row").isNull(), nulls)),
                   F.lit(0)).alias("null_values"))
    if bad_rows == "drop":
        kept = checked(kept, bad_rows)
    write_table(kept.drop("bad_row"), target, mode, compression)
    got = seen.get
    counts = {"rows": got["read"] - (got["bad_rows"] if bad_rows == "drop" else 0),
              "bad_rows": got["bad_rows"], "null_values": got["null_values"]}
    (files.withColumns({"options": F.lit(options), **{c: F.lit(n).cast("bigint") for c, n in counts.items()}})
          .write.mode("overwrite").parquet(_manifest(target)))
    return counts


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def refresh_bronze(spark: SparkSession, sources: Mapping[str, str], target_dir: str,
                   tables: Sequence[str] | None = None, mode: str = "truncate",
                   force: bool = False, fail_fast: bool = False,
                   na_tokens=None, compression: str = "snappy",
                   parallel_tables: int = 1, bad_rows: str = "null") -> DataFrame:
    """Load ``sources`` (table -> TSV path) into ``target_dir/<table>``.

    Each table is an independent Spark job; ``parallel_tables > 1`` submits
    several at once from driver threads so small tables share the cluster.
    Returns a report DataFrame (``REPORT_SCHEMA``): ``forced`` marks a load
    that was not needed, ``bad_rows`` the malformed rows (kept or not by the
    policy of that name), ``null_values`` the NULLs among the loaded values.
    A skipped table reports the counts of its last load.
    """
    names = list(tables) if tables else list(sources)
    unknown = [t for t in names if t not in sources]
    if unknown:
        raise ValueError(f"unknown tables: {unknown}")

    def load(name: str) -> Row:
        target = table_path(target_dir, name)
        try:
            options = load_options(name, na_tokens, compression, mode, bad_rows)
            fresh = is_fresh(spark, sources[name], target, options)
            skipped = fresh and not force
            if skipped:
                counts = spark.read.parquet(_manifest(target)).select(*COUNTS).first().asDict()
            else:
                counts = load_table(spark, name, sources[name], target, na_tokens, mode, compression, bad_rows)
            return Row(table_name=name, ok=True, skipped=skipped, rows=counts["rows"], error=None,
                       forced=fresh and force, bad_rows=counts["bad_rows"], null_values=counts["null_values"])
        except Exception as e:  # reported per table, like the original loader
            if fail_fast:
                raise
            return Row(table_name=name, ok=False, skipped=False, rows=None,
                       error=f"{type(e).__name__}: {e}", forced=False, bad_rows=None, null_values=None)

    if parallel_tables > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
            rows = list(pool.map(load, names))
    else:
        rows = [load(n) for n in names]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def exit_status(report: DataFrame) -> int:
    """0 all ok, 1 some failed, 2 all failed (the loader's exit codes)."""
    all_ok, any_ok = report.agg(F.bool_and("ok"), F.bool_or("ok")).first()
    if all_ok:
        return 0
    return 1 if any_ok else 2
