"""Quality classifier by hierarchical empirical Bayes (operator 2).

Evidence of a document: binned ratios of its text counts, each with the log
likelihood ratio of good to bad labelled documents in the same bin (add-one
smoothing).  Their sum, times ``temper`` because the ratios depend on each
other, is the document's evidence.

Prior of a document: the share of good documents at its site.  A site has
two levels, host and path.  The share of a host is its labelled documents
shrunk towards the global share, that of a path its own shrunk towards its
host; how strongly is estimated from the spread between hosts, and between
paths within hosts (method of moments for a beta-binomial).  Sites without
labels take their parent's share.

All statistics are grouped aggregations over all labelled documents; the
driver sees only their totals.  Null hosts or paths form a group of their
own, null texts count as empty, and unlabelled documents are scored alike.
Repeated rows are scored each; an id labelled twice counts as bad if any of
its labels is; other columns are ignored, whatever their names; an empty
table gives an empty one, and without labels every score is 0.5.  The given
tables have no addresses: ``source`` stands for the host, ``lang`` for the path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise
from marquee.llm.features import document_counts

BINS = 12


def _ratio_bin(a: str, b: str) -> Column:
    """Twelve bins of a ratio, finer near zero."""
    r = F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return F.least(F.lit(BINS - 1), F.floor(F.sqrt(F.least(r, F.lit(1.0))) * (BINS - 1) + F.when(r > 0, 1).otherwise(0)))


def _evidence_bins() -> dict[str, Column]:
    return {
        "symbols": _ratio_bin("n_symbols", "n_words"),
        "dup_lines": _ratio_bin("n_dup_lines", "n_lines"),
        "repeats": _ratio_bin("n_repeat_words", "n_words"),
        "capitals": _ratio_bin("n_upper", "word_chars"),
        "digits": _ratio_bin("n_digits", "word_chars"),
        "marks": _ratio_bin("n_marks", "n_words"),
        "length": F.least(F.lit(BINS - 1), F.floor(F.log2(F.col("n_words") + 1.0))),
        "word_length": F.when(F.col("n_words") > 0, F.least(F.lit(BINS - 1), F.floor(
            F.col("word_chars") / F.col("n_words")))).otherwise(0),
    }


def strength(groups: int, n: float, n2: float, spread: float, p: float) -> float:
    """Prior strength of a beta-binomial by moments.

    ``spread``: sum over groups of size * (share - parent's share) ** 2,
    ``n``: sum of sizes, ``n2``: sum of squared sizes.
    """
    within = p * (1 - p)
    room = n - n2 / n if n else 0.0
    between = (spread - (groups - 1) * within) / room if room > 0 else 0.0
    return min(1e6, max(1.0, within / between - 1.0)) if between > 0 and within > 0 else 1e6


def _shrunk(level: DataFrame, parent: str, p: float, name: str) -> DataFrame:
    """level (n, k, <parent>): the posterior share of each group."""
    share = F.col("k") / F.col("n")
    t = level.agg(F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
                  F.sum(F.col("n") * F.pow(share - F.col(parent), 2)).alias("s")).first()
    m = strength(t.g, float(t.n or 0), float(t.n2 or 0), float(t.s or 0), p)
    return level.withColumn(name, (F.col("k") + m * F.col(parent)) / (F.col("n") + m)).drop("n", "k", parent)


def quality_scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
                   temper: float = 0.5, threshold: float = 0.5) -> DataFrame:
    """docs (doc_id, text, <host>, <path>), labels (doc_id, quality 0/1) ->
    doc_id, evidence, host_share, path_share, score and kept, a row per row."""
    rows = docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), "text")
    bins = _evidence_bins()
    counts = document_counts(rows)
    feats = materialise(counts.select("doc_id", "host", "path", *[v.cast("int").alias(f"b_{k}") for k, v in bins.items()]),
                        "quality-bins")
    known = (labels.filter("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min(F.when(F.col("quality") >= 1, 1).otherwise(0)).alias("good")))
    labelled = feats.join(known, "doc_id")

    n, k = (float(x or 0) for x in labelled.agg(F.count("*"), F.sum("good")).first())
    p = (k + 1) / (n + 2)
    # evidence: at most features x bins rows, as a literal map per feature
    table = labelled.select("good", F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in bins])).alias("x")).groupBy("x.f", "x.b").agg(
        F.sum("good").alias("g"), F.count("*").alias("n")).collect()
    llr = {(r.f, r.b): math.log((r.g + 1) / (k + BINS)) - math.log((r.n - r.g + 1) / (n - k + BINS)) for r in table}
    evidence = F.lit(0.0)
    for f in bins:
        values = [llr.get((f, b), 0.0) for b in range(BINS)]
        evidence = evidence + F.get(F.lit(values), F.col(f"b_{f}"))

    sums = [F.count("*").cast("double").alias("n"), F.sum("good").cast("double").alias("k")]
    # written first: their known size lets the joins below copy small tables to
    # the tasks instead of sending all rows of one host to one task
    hosts = materialise(_shrunk(labelled.groupBy("host").agg(*sums).withColumn("p0", F.lit(p)), "p0", p, "host_share"),
                        "quality-hosts")
    paths = materialise(_shrunk(labelled.groupBy("host", "path").agg(*sums).join(hosts, "host")
                                .withColumnRenamed("host_share", "ph"), "ph", p, "path_share"), "quality-paths")
    joined = (feats.join(hosts, "host", "left").join(paths, ["host", "path"], "left")
              .withColumn("host_share", F.coalesce("host_share", F.lit(p)))
              .withColumn("path_share", F.coalesce("path_share", "host_share"))
              .withColumn("evidence", temper * evidence))
    share = F.col("path_share")
    score = 1.0 / (1.0 + F.exp(-(F.log(share / (1.0 - share)) + F.col("evidence"))))
    return joined.select("doc_id", "evidence", "host_share", "path_share", score.alias("score"),
                         (score >= threshold).alias("kept"))
