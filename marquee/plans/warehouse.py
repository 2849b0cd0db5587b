"""The models as catalog tables: bronze, one base for the fact, people, marts.

Layout (``root/<table>``, registered as ``<prefix><table>``):

* bronze tables as loaded;
* ``base``: titles with their ratings, written once and bucketed by
  ``movie_id``, so the fact joins both people arrays to it without moving it;
* ``people``: bucketed by ``person_id`` for the dimensions;
* ``movies``: partitioned by release decade, clustered by votes;
* ``dim_directors``, ``dim_actors``: bucketed by the person's id.

The joins that can meet a hot key (credits with the ids of the base, credits
with people) read these tables by path, without their buckets: both sides are
then shuffled and adaptive execution can split the hot partition, which a
bucketed scan would forbid.  Questions read the written marts only.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.plans import marts, staging
from marquee.plans.pipeline import Models, Params
from marquee.sources.sinks import clustered_movies

MARTS = ("movies", "dim_directors", "dim_actors")
BUCKETS = {"base": "movie_id", "people": "person_id", "dim_directors": "director_id",
           "dim_actors": "actor_id"}
PARTITIONS = {"movies": "release_decade"}
COMPRESSION = "zstd"
PARALLEL_TABLES = 4
LAYOUT_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()),
                              T.StructField("rows", T.LongType()),
                              T.StructField("buckets", T.LongType())])


class Warehouse:
    """Tables under ``root``; ``prefix`` keeps their catalog names apart from others."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int | None = None,
                 params: Params | None = None):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.params = params or Params()
        self.rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """The catalog table, with its buckets and partitions."""
        return self.spark.table(f"{self.prefix}{name}")

    def scan(self, name: str) -> DataFrame:
        """The table's files without its buckets (for joins on keys that can be hot)."""
        return self.spark.read.schema(self.table(name).schema).parquet(self.path(name))

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write and register a table; its row count is observed during the write."""
        self.rows[name] = self._write(name, df)
        return self.table(name)

    def save_all(self, tables: Mapping[str, DataFrame]) -> None:
        """Save tables that do not read each other, several at once: one's last tasks leave cores to the next."""
        def write(name: str) -> int:
            return self._write(name, tables[name])

        with ThreadPoolExecutor(max_workers=PARALLEL_TABLES) as pool:
            self.rows.update(zip(tables, pool.map(inheritable_thread_target(self.spark)(write), tables)))

    def _write(self, name: str, df: DataFrame) -> int:
        seen = Observation(f"{name}-rows")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        key = BUCKETS.get(name)
        if key:
            # same hash as the buckets: one file for each, small ones share a task
            df = df.repartition(self.buckets, key)
        w = (df.write.mode("overwrite").format("parquet").option("path", self.path(name))
               .option("compression", COMPRESSION))
        if key:
            w = w.bucketBy(self.buckets, key).sortBy(key)
        if name in PARTITIONS:
            w = w.partitionBy(PARTITIONS[name])
        w.saveAsTable(f"{self.prefix}{name}")
        return seen.get["rows"]

    def load_bronze(self, tables: Mapping[str, DataFrame]) -> None:
        self.save_all(tables)

    def models(self) -> Models:
        """Staging over the bronze tables on disk."""
        from marquee.sources.bindings import LazyTables
        names = [n for n in self.rows if n not in BUCKETS and n not in PARTITIONS]
        return Models(LazyTables(self.table, names), self.params)

    def build(self) -> DataFrame:
        """Write base, people and the marts from the bronze tables; returns (table_name, rows, buckets)."""
        m, p = self.models(), self.params
        self.save_all({"base": m.stg_title_basics.join(m.stg_ratings, "movie_id"), "people": m.stg_person})
        self.save("movies", clustered_movies(self.fact()))
        movies, people = self.table("movies"), self.table("people")
        self.save_all({"dim_directors": marts.dim_directors(movies, people, p.as_of),
                       "dim_actors": marts.dim_actors(movies, people, p.as_of, p.lead_position)})
        return self._write_layout()

    def fact(self) -> DataFrame:
        """The ``movies`` plan over the written base: titles and ratings are not joined again."""
        b = self.models().bronze
        ids, people = self.scan("base").select("movie_id"), self.scan("people")
        crew = staging.stg_crew(b["title_crew"], people, ids)
        actor = staging.stg_actor(b["title_principals"], people, ids)
        return marts.movies_from_base(self.table("base"), crew, actor, self.params.top_actors)

    def _write_layout(self) -> DataFrame:
        rows = [(n, c, self.buckets if n in BUCKETS else None) for n, c in self.rows.items()]
        out = self.spark.createDataFrame(rows, LAYOUT_SCHEMA)
        out.coalesce(1).write.mode("overwrite").parquet(self.path("layout"))
        return out

    def attach(self) -> Warehouse:
        """Register the tables of an earlier session (one row each in ``layout``) without rewriting them."""
        for name, n, buckets in self.spark.read.schema(LAYOUT_SCHEMA).parquet(self.path("layout")).collect():
            schema = self.spark.read.parquet(self.path(name)).schema
            how = f"PARTITIONED BY ({PARTITIONS[name]})" if name in PARTITIONS else ""
            if buckets:
                how = f"CLUSTERED BY ({BUCKETS[name]}) SORTED BY ({BUCKETS[name]}) INTO {buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.prefix}{name} ({schema.toDDL()}) USING parquet "
                           f"{how} LOCATION '{self.path(name)}'")
            if name in PARTITIONS:
                self.spark.catalog.recoverPartitions(f"{self.prefix}{name}")
            self.rows[name] = n
        return self

    def drop(self) -> None:
        """Take the tables out of the catalog (their files stay)."""
        for name in self.rows:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}{name}")
