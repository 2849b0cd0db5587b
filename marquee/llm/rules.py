"""Quality rules with risk-controlled cutoffs (operator 4).

Each rule is a ratio of the document counts, in thousandths, and rejects a
document whose value is at its cutoff or above.  Cutoffs come from a
labelled holdout, per stratum:

* the good documents of the holdout that pass the base rules form the
  sample; a cutoff is *admissible* if the exact (Clopper-Pearson) upper
  bound of its false-rejection rate is at most ``max_false_rejection``;
* going down from the largest value, the test is a fixed sequence, so the
  bound holds for all admissible cutoffs of a rule at once; over rules and
  strata the level is divided by their number (Bonferroni);
* of the admissible cutoffs the one with the best balance is used: rejected
  bad documents minus ``cost`` times rejected good ones, the larger cutoff
  on ties.  Where no cutoff gains anything, or the stratum has too few
  labels for the guarantee, the rule is off there.

Null text counts as empty: no words, hence rejected by the base rules.
Documents with a null stratum form one stratum.  A document with several
labels counts as its smallest quality; null labels are left out.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise, ship
from marquee.llm.features import COUNTS, document_counts

#: rule: numerator, denominator
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "n_words"),
}
TOP = 1000


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _value(rule: str) -> F.Column:
    a, b = RULES[rule]
    return F.when(F.col(b) > 0, F.least(F.lit(TOP), F.floor(TOP * F.col(a) / F.col(b)))).otherwise(0).cast("int")


def most_rejections(n: int, rate: float, level: float) -> int:
    """Largest k for which ``n`` trials with ``k`` successes still show, at
    ``level``, a success rate of at most ``rate``; -1 if not even 0 does.

    The exact upper bound is at most ``rate`` if and only if
    P(Binomial(n, rate) <= k) <= level.
    """
    if n <= 0:
        return -1
    total, k = 0.0, -1
    log_q, log_p = math.log1p(-rate), math.log(rate)
    while k + 1 <= n:
        j = k + 1
        total += math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * log_p + (n - j) * log_q)
        if total > level:
            break
        k = j
    return k


def _choose(hist: pd.DataFrame, rate: float, level: float, cost: float) -> pd.DataFrame:
    """One stratum's histogram (rule, value, good, bad) -> its cutoffs."""
    out = []
    for rule, g in hist.groupby("rule"):
        g = g.sort_values("value", ascending=False)
        k = most_rejections(int(g["good"].sum()), rate, level)
        good, bad = g["good"].cumsum(), g["bad"].cumsum()
        gain = (bad - cost * good).where((good <= k) & (g["value"] > 0), 0)
        if len(gain) and gain.max() > 0:
            out.append((hist["stratum"].iloc[0], rule, int(g["value"].iloc[int(gain.to_numpy().argmax())])))
    return pd.DataFrame(out, columns=["stratum", "rule", "cutoff"])


def cutoffs(labelled: DataFrame, rate: float, level: float, cost: float) -> DataFrame:
    """labelled (stratum, quality, counts) -> (stratum, one cutoff column per rule)."""
    ship(labelled.sparkSession)
    values = labelled.filter(~base_failed()).select("stratum", "quality", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), _value(r).alias("value")) for r in RULES])).alias("r"))
    hist = values.groupBy("stratum", "r.rule", "r.value").agg(
        F.sum(F.when(F.col("quality") >= 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") < 1, 1).otherwise(0)).alias("bad"))
    strata = max(1, labelled.select("stratum").distinct().count())
    each = level / (strata * len(RULES))
    chosen = hist.groupBy("stratum").applyInPandas(
        lambda h: _choose(h, rate, each, cost), "stratum string, rule string, cutoff int")
    return chosen.groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false_rejection: float = 0.02,
                  level: float = 0.05, cost: float = 10.0, passed: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, <stratum>), labels (doc_id, quality) -> a row per
    document: doc_id, the counts, base_failed, failed_rules, kept, and the
    columns ``passed`` as they are."""
    rows = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text", *passed)
    counts = materialise(document_counts(rows), "quality-counts")
    known = (labels.filter("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    # one row per stratum, written so that Spark knows its size: a small table is
    # broadcast and no stratum's documents have to meet in one task
    cuts = materialise(cutoffs(counts.join(known, "doc_id"), max_false_rejection, level, cost), "quality-cutoffs")
    failed = F.filter(F.array(*[
        F.when(_value(r) >= F.col(f"cut_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return (counts.join(cuts, "stratum", "left").withColumn("base_failed", base_failed())
            .withColumn("failed_rules", failed)
            .select("doc_id", *COUNTS, "base_failed", "failed_rules",
                    (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), *passed))
