"""Driver tables -> bronze-shaped tables (the test inputs of FIXTURES.md §3).

part plays the title, customer the person, lineitem joined to orders the
credit.  The outputs are raw text as a TSV would hold it (``\\N`` and empty
strings included); :func:`marquee.sources.tsv.normalize_na` turns those into
NULLs exactly as the bronze loader does.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import SOURCE_NULL

BOUND_TABLES = ("title_basics", "title_ratings", "name_basics", "title_crew",
                "title_principals", "title_akas", "title_episode")


_SCHEMAS: dict[str, object] = {}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; its schema is inferred once per path and reused
    (inference runs a small job per read otherwise)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Modification time and size of the driver tables that the bindings read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in ("part", "customer", "orders", "lineitem"):
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        st = p.getFileSystem(conf).getFileStatus(p)
        out.append((st.getModificationTime(), st.getLen()))
    return tuple(out)


def _padded_id(prefix: str, x) -> F.Column:
    # prefix + 7-digit zero-padded key; longer keys are kept whole instead of
    # being cut to 7 characters, so ids stay unique at any scale.
    s = F.col(x).cast("string") if isinstance(x, str) else x.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= 7, s).otherwise(F.lpad(s, 7, "0")))


def tt(x) -> F.Column:
    return _padded_id("tt", x)


def nm(x) -> F.Column:
    return _padded_id("nm", x)


def _na() -> F.Column:
    return F.lit(SOURCE_NULL)


def title_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        tt(k).alias("tconst"),
        F.when(F.col("p_type") == "PROMO", "short")
         .when(F.col("p_type") == "SMALL", "tvSeries").otherwise("movie").alias("titleType"),
        F.when(k % 97 == 0, "").otherwise(F.col("p_name")).alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        F.when(k % 20 == 0, 1).otherwise(0).cast("int").alias("isAdult"),
        F.when(k % 31 == 0, _na()).otherwise((F.lit(1940) + k % 86).cast("string")).alias("startYear"),
        _na().alias("endYear"),
        F.when(F.col("p_size") % 13 == 0, _na())
         .otherwise((F.lit(60) + 2 * F.col("p_size")).cast("string")).alias("runtimeMinutes"),
        F.when(k % 4 == 0, "Drama").when(k % 4 == 1, "Drama,Sci-Fi")
         .when(k % 4 == 2, "Action,Comedy,Drama").otherwise(_na()).alias("genres"),
    )


def title_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.filter(k % 11 != 0).select(
        tt(k).alias("tconst"),
        ((k * 37) % 101).cast("double").__truediv__(F.lit(10.0)).alias("averageRating"),
        ((k * 7919) % 200000).cast("bigint").alias("numVotes"),
    )


def name_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    birth = F.lit(1790) + (k * 7) % 240
    return c.select(
        nm(k).alias("nconst"),
        F.when(k % 89 == 0, "").otherwise(F.col("c_name")).alias("primaryName"),
        F.when(k % 17 == 0, _na()).otherwise(birth.cast("string")).alias("birthYear"),
        F.when((k % 3 == 0) & (k % 17 != 0), (birth + 60).cast("string"))
         .otherwise(_na()).alias("deathYear"),
        F.lower("c_mktsegment").alias("primaryProfession"),
        F.when(k % 23 == 0, "").otherwise(tt(k)).alias("knownForTitles"),
    )


def _credits(spark: SparkSession, sf_dir: str, cols: list) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.select(*cols).join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def title_principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # through the join's shuffle the line's own values are one short text: returned or
    # not, number (nothing if null), colon and status (neither if null)
    line = F.concat(F.when(F.col("l_returnflag") == "R", "R").otherwise("-"),
                    F.coalesce(F.col("l_linenumber").cast("string"), F.lit("")),
                    F.coalesce(F.concat(F.lit(":"), F.col("l_linestatus")), F.lit("")))
    cr = _credits(spark, sf_dir, ["l_orderkey", "l_partkey", line.alias("line")])
    number = F.nullif(F.expr("substring(substring_index(line, ':', 1), 2)"), F.lit(""))
    status = F.expr("CASE WHEN contains(line, ':') THEN substring(line, locate(':', line) + 1) END")
    # row-local: the models need an order of a title's credits, not a gap-free number
    ordering = F.col("l_orderkey") * 16 + number.cast("bigint")
    pk, ck = F.col("l_partkey"), F.col("o_custkey")
    category = (F.when(F.col("line").startswith("R") | (pk % 19 == 0), "producer")
                 .when(ck % 29 == 0, F.when(status == "F", "actor")
                       .otherwise("actress"))
                 .when(ck % 2 == 0, "actor").otherwise("actress"))
    return cr.select(
        tt(pk).alias("tconst"),
        ordering.cast("bigint").alias("ordering"),
        nm(ck).alias("nconst"),
        category.alias("category"),
        F.lit(None).cast("string").alias("job"),
        F.concat(F.lit('["'), status, number, F.lit('"]')).alias("characters"),
    )


def title_crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    cr = (_credits(spark, sf_dir, ["l_orderkey", "l_partkey", "l_returnflag"])
          .filter(F.col("l_returnflag") == "R"))
    # one shuffle of bare keys by title serves the distinct (title, person) and
    # the list; ids are formatted after it.
    pairs = cr.select("l_partkey", "o_custkey").repartition("l_partkey").distinct()
    lists = pairs.groupBy("l_partkey").agg(
        F.array_join(F.array_sort(F.collect_list(nm("o_custkey"))), ",").alias("directors"))
    p = read_driver(spark, sf_dir, "part").select("p_partkey")
    return (p.join(lists, F.col("p_partkey") == F.col("l_partkey"), "left")
             .select(tt("p_partkey").alias("tconst"),
                     F.coalesce(F.col("directors"), _na()).alias("directors"),
                     _na().alias("writers")))


def title_akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other titles: the part's name as it is and its upper-case form under a region."""
    p = read_driver(spark, sf_dir, "part")
    k = F.col("p_partkey")
    forms = F.explode(F.array(
        F.struct(F.lit("1").alias("ordering"), F.col("p_name").alias("title"), _na().alias("region"),
                 F.lit("1").alias("original")),
        F.struct(F.lit("2").alias("ordering"), F.upper("p_name").alias("title"),
                 F.when(k % 3 == 0, "NA").otherwise("FR").alias("region"), F.lit("0").alias("original"))))
    return p.select(k.alias("k"), forms.alias("f")).select(
        tt("k").alias("titleId"), "f.ordering", "f.title", "f.region", _na().alias("language"),
        _na().alias("types"), _na().alias("attributes"), F.col("f.original").alias("isOriginalTitle"))


def title_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third part is an episode of the title ten numbers below (some without a season)."""
    p = read_driver(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.filter(k % 3 == 1).select(
        tt(k).alias("tconst"), tt(k - k % 10).alias("parentTconst"),
        F.when(k % 7 == 0, _na()).otherwise((k % 5).cast("string")).alias("seasonNumber"),
        F.col("p_size").cast("string").alias("episodeNumber"))


BINDERS = {
    "title_akas": title_akas,
    "title_episode": title_episode,
    "title_basics": title_basics,
    "title_ratings": title_ratings,
    "name_basics": name_basics,
    "title_crew": title_crew,
    "title_principals": title_principals,
}


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with what the test table lacks: a time of each turn, the model
    asked, and the SQL an answer executed (all computed from the row)."""
    c = read_driver(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    us = F.lit(1_704_067_200_000_000) + conv * 3_600_000_000 + turn * 37_000_000
    model = F.element_at(F.array(*[F.lit(m) for m in ("model-a", "model-b", "model-c")]),
                         F.pmod(conv + F.floor(turn / 2), F.lit(3)).cast("int") + 1)
    return c.select("conv_id", "turn", "role", "text", F.timestamp_micros(us).alias("ts"), model.alias("model"),
                    F.when((F.col("role") == "assistant") & (F.length("text") % 3 == 0), "SELECT 1").alias("sql"))


def raw_bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Bronze-shaped raw text table bound from the driver tables."""
    return BINDERS[name](spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str, name: str, na_tokens=None) -> DataFrame:
    """Bound bronze table after the loader's NULL-token step."""
    from marquee.sources.tsv import normalize_na
    return normalize_na(raw_bronze(spark, sf_dir, name), na_tokens)


class LazyTables(Mapping):
    """Table name -> DataFrame, each built on first access (some bindings run
    an eager job, which unrelated queries should not pay for)."""

    def __init__(self, make, names):
        self._make, self._names, self._built = make, tuple(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._make(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def bronze_tables(spark: SparkSession, sf_dir: str, na_tokens=None) -> Mapping[str, DataFrame]:
    return LazyTables(lambda n: bronze(spark, sf_dir, n, na_tokens), BOUND_TABLES)
