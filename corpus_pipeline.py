"""Training-corpus pipeline: five stages over ``documents``.

``run`` writes each stage's result as Parquet under the shared scratch root
and reads it back as the next stage's input.  Every stage works on all rows
that its predecessor kept; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontam, jaccard, rules, sentencepiece, suffix_dedup
from marquee.llm.common import materialise

# near duplicates: five words, similarity of 0.8 or more
SHINGLE_WORDS, SIMILARITY_PCT = 5, 80
# repeats: strings of so many bytes (for text without blanks), and every passage of over 50 words
REPEAT_BYTES, REPEAT_WORDS = 400, 51


#: names a row by its content: a hash of the columns besides the text, 128 bits of the text.
#: Rows with one key are copies of each other, so every decision holds for all of them
KEY = ("_key0", "_key1", "_key2")


def _keyed(docs: DataFrame) -> DataFrame:
    """What the operators read, the key, and the whole row as one column: columns
    of ``docs`` may have any names."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", *(["lang"] if "lang" in docs.columns else []), F.struct(*docs.columns).alias("row"),
                       *(e.alias(k) for k, e in zip(KEY, (
                           F.xxhash64(F.to_json(F.struct(*others), {"ignoreNullFields": "false"})),
                           F.xxhash64("text"), F.xxhash64(F.lit(1), "text")))))


def _drop(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``keys``."""
    return _keyed(docs).join(keys.select(*KEY).distinct(), list(KEY), "left_anti").select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (4): documents that a rule rejects go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    verdict = rules.quality_rules(_keyed(docs).drop("row"), labels, passed=KEY)
    return _drop(docs, verdict.filter("not kept"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (1): one row of each group stays, that with the
    smallest doc_id (null last); rows without words are no group."""
    groups = materialise(jaccard.ngram_jaccard_components(
        _keyed(docs).drop("row"), k=SHINGLE_WORDS, pct=SIMILARITY_PCT, passed=KEY).filter("`group` is not null"), "pipeline-groups")
    first = materialise(groups.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY)).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("group", F.struct(*(f"first.{c}" for c in KEY)).alias("first")), "pipeline-first")
    # the first row's copies have its key, too
    marked = materialise(groups.join(first, "group").groupBy(*KEY).agg(
        F.max(F.struct(*KEY) == F.col("first")).alias("stays"), F.count("*").alias("copies"))
        .filter("copies > 1 or not stays"), "pipeline-marked")
    once = _keyed(docs).join(marked.filter("stays").select(*KEY), list(KEY), "left_semi").dropDuplicates(list(KEY))
    return _drop(docs, marked).unionByName(once.select("row.*"))


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (8): repeated byte and word strings are cut out of the texts."""
    cols = docs.columns
    mark = "_"
    while any(c.startswith(mark) for c in cols):
        mark += "_"
    out = suffix_dedup.suffix_dedup(docs, REPEAT_BYTES, words=REPEAT_WORDS, mark=mark)
    cut = out.withColumn("text", F.col(f"{mark}kept"))
    if "n_chars" in cols:
        cut = cut.withColumn("n_chars", F.when(F.col(f"{mark}n_removed") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*cols)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (7): documents that hold an item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows = _keyed(docs).select(F.struct(*KEY).alias("doc_id"), "text")
    return _drop(docs, decontam.benchmark_matches(rows, benchmark).select("doc_id.*"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding (3): ids instead of texts."""
    return sentencepiece.encode(docs.select("doc_id", "text")).select("doc_id", "n_pieces", "round_trip", "ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", repeat_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: the learned cutoffs, the byte-level dedup, the edit matching and the
#: encoding have no SQL form; tests hold the pipeline against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
