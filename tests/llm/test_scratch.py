"""Shuffle files and scratch tables of the operators with several passes."""

import random
import time

from marquee.llm import sentencepiece, suffix_dedup
from marquee.llm.common import free_shuffles, materialise


def shuffle_files(spark):
    """Bytes of the files of shuffles by name."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def left_over(spark, before):
    """Bytes of the shuffles that came since and stay."""
    for _ in range(20):
        if not (more := sum(n for k, n in shuffle_files(spark).items() if k not in before)):
            break
        time.sleep(0.2)   # files are deleted in the background
    return more


def test_files_of_the_last_query_go(spark):
    free_shuffles(spark)
    before = shuffle_files(spark)
    out = materialise(spark.range(5000).selectExpr("id % 97 as k").groupBy("k").count(), "shuffled")
    assert not left_over(spark, before) and out.count() == 97


def test_encoding_holds_no_shuffle_before_the_texts_move(spark):
    r = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join("".join(r.choices("abcdefgh", k=9)) for _ in range(30)))
                                  for i in range(60)], "doc_id long, text string")
    free_shuffles(spark)
    before = shuffle_files(spark)
    out = sentencepiece.encode(docs, hot=5)
    # the counts of segments by frequency are some rows
    assert left_over(spark, before) < 2000
    assert out.filter("round_trip").count() == 60


def test_ranges_of_words_hold_no_shuffle(spark):
    text = " ".join(f"word{i}" for i in range(120))
    docs = spark.createDataFrame([(1, text), (2, "a b c " + text), (3, None)], "doc_id long, text string")
    free_shuffles(spark)
    before = shuffle_files(spark)
    spans = suffix_dedup.repeated_words(docs, 51)
    assert not left_over(spark, before)
    assert sorted(r.rid for r in spans.collect()) == [1, 2]
