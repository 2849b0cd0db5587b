"""Tab-separated bronze scans and the NULL-token step."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.scalar import null_tokens
from marquee.schemas import BRONZE_SCHEMAS, DEFAULT_NA_TOKENS, SOURCE_NULL

# no quoting: a field that starts with a quote does not swallow the tabs after it
TSV_OPTIONS = {"sep": "\t", "quote": "", "escape": "", "recursiveFileLookup": True}


def normalize_na(df: DataFrame, tokens: Iterable[str] | None = None) -> DataFrame:
    """Turn NULL tokens into NULL in every string column (one projection)."""
    tokens = DEFAULT_NA_TOKENS if tokens is None else tuple(tokens)
    cols = [null_tokens(f.name, tokens).alias(f.name)
            if isinstance(f.dataType, T.StringType) else f.name
            for f in df.schema.fields]
    return df.select(*cols)


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of every file below ``path``, nested ones too.

    The listing is Spark's own (parallel for many folders, no content is
    read) and is taken once, when this DataFrame is made.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of the header line (files whose header differs fail when they are read)."""
    return spark.read.options(**TSV_OPTIONS, header=True, inferSchema=False).csv(path).columns


def _reason(fields: list, raw: str) -> F.Column:
    """Why a row is bad: its number of fields, or the first column that is not of its type."""
    reason = F.when(F.col(raw).isNotNull(), F.lit("fields"))
    for name, text, typed in fields:
        reason = reason.when(text.isNotNull() & typed.isNull(), F.lit(f"type:{name}"))
    return reason


def scan_tsv(spark: SparkSession, path: str, schema: T.StructType | str,
             na_tokens: Iterable[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """The columns of ``schema`` and ``bad_row``: why a row does not hold what its file promises.

    Columns are found by their names in the header, in any order; further
    ones are ignored, a missing one is an error.  A row with too few or too
    many fields keeps those it has and is marked ``fields``; a value that is
    not of its column's type is NULL and marked ``type:<column>``.
    """
    if isinstance(schema, str):
        schema = BRONZE_SCHEMAS[schema]
    tokens = DEFAULT_NA_TOKENS if na_tokens is None else tuple(na_tokens)
    names = header_columns(spark, path)
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)} (it has {', '.join(names) or 'no columns'})")
    raw = "_raw_row"
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, raw)])
    df = (spark.read.schema(text)
          .options(**TSV_OPTIONS, header=True, nullValue=SOURCE_NULL, mode="PERMISSIVE",
                   columnNameOfCorruptRecord=raw, enforceSchema=False, columnPruning=False)
          .csv(path))
    if min_partitions:
        n, zipped = source_files(spark, path).agg(
            F.count(F.lit(1)), F.count_if(F.lower("path").endswith(".gz"))).first()
        if zipped and n < min_partitions:
            # one task per gzip file: spread the rows before any further work
            df = df.repartition(min_partitions)
    out, typed = [], []
    for f in schema:
        value = null_tokens(f.name, tokens)
        if not isinstance(f.dataType, T.StringType):
            cast = value.try_cast(f.dataType)
            typed.append((f.name, value, cast))
            value = cast
        out.append(value.alias(f.name))
    return df.select(*out, _reason(typed, raw).alias("bad_row"))


def checked(rows: DataFrame, bad_rows: str = "null") -> DataFrame:
    """Rows of :func:`scan_tsv` by policy: ``null`` keeps bad rows with what they
    hold, ``drop`` leaves them out, ``fail`` ends the job with the first one."""
    if bad_rows == "drop":
        return rows.filter("bad_row IS NULL")
    if bad_rows == "fail":
        key = F.coalesce(F.col(rows.columns[0]).cast("string"), F.lit("NULL"))
        stop = F.raise_error(F.concat(F.lit(f"malformed row, {rows.columns[0]} "), key, F.lit(": "), F.col("bad_row")))
        return rows.withColumn("bad_row", F.when(F.col("bad_row").isNotNull(), stop).cast("string"))
    if bad_rows != "null":
        raise ValueError(f"unknown policy for bad rows {bad_rows!r}")
    return rows


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str,
             na_tokens: Iterable[str] | None = None, min_partitions: int | None = None,
             bad_rows: str = "null") -> DataFrame:
    """Read tab-separated text with a header (gzip or plain) into typed columns.

    ``quote`` is disabled so that a field starting with a double quote does
    not swallow the following tabs.  Gzip files are not splittable: each file
    is one task, so ``min_partitions`` spreads the rows before further work.
    ``bad_rows`` is the policy of :func:`checked`.
    """
    rows = checked(scan_tsv(spark, path, schema, na_tokens, min_partitions), bad_rows)
    if bad_rows == "fail":  # the check must run though its column is not returned
        rows = rows.filter("bad_row IS NULL")
    return rows.drop("bad_row")


def write_tsv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> str:
    """Write a table in the source layout (tab separated, header, ``\\N`` for NULL)."""
    (df.write.mode(mode)
       .options(sep="\t", header=True, quote="", escape="", nullValue=SOURCE_NULL,
                emptyValue="", compression=compression)
       .csv(path))
    return path
