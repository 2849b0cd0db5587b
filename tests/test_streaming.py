import os

import pytest

from marquee.streaming import (USAGE_RECORD_SCHEMA, prune_versions, publish, read_published,
                               stream_history, stream_model_counts, versions)


def _records(spark, rows):
    return spark.createDataFrame(rows, USAGE_RECORD_SCHEMA)


def test_history_append_resumes(spark, tmp_out):
    landing, hist, ck = (os.path.join(tmp_out, x) for x in ("in", "hist", "ck"))
    _records(spark, [(1, 0, "user", "q1", 3, 0), (1, 1, "assistant", None, 0, 9)]) \
        .write.mode("append").parquet(landing)
    stream_history(spark, landing, hist, ck)
    assert spark.read.parquet(hist).count() == 2
    _records(spark, [(2, 0, "user", "q2", 4, 0)]).write.mode("append").parquet(landing)
    stream_history(spark, landing, hist, ck)
    assert spark.read.parquet(hist).count() == 3          # no duplicates after restart


def test_model_counts_state(spark, tmp_out):
    landing, out, ck = (os.path.join(tmp_out, x) for x in ("in", "out", "ck"))
    _records(spark, [(1, 0, "a", None, 1, 0), (1, 1, "b", None, 1, 0)]).write.mode("append").parquet(landing)
    stream_model_counts(spark, landing, out, ck)
    _records(spark, [(2, 0, "a", None, 1, 0)]).write.mode("append").parquet(landing)
    stream_model_counts(spark, landing, out, ck)
    assert {r.model: r.uses for r in read_published(spark, out).collect()} == {"a": 2, "b": 1}
    assert versions(spark, out) == [0, 1]


def test_replayed_version_changes_nothing(spark, tmp_out):
    table = os.path.join(tmp_out, "t")
    with pytest.raises(FileNotFoundError):
        read_published(spark, table)
    assert publish(spark.range(3), table, 0, "w") and publish(spark.range(5), table, 1, "w")
    assert not publish(spark.range(9), table, 1, "w") and not publish(spark.range(9), table, 0, "w")
    assert read_published(spark, table).count() == 5
    with pytest.raises(ValueError):
        publish(spark.range(9), table, 2, "another")


def test_unfinished_version_is_not_seen_and_is_written_anew(spark, tmp_out):
    table = os.path.join(tmp_out, "t")
    publish(spark.range(3), table, 0)
    spark.range(7).write.parquet(f"{table}/version=1")       # failed before its marker
    assert read_published(spark, table).count() == 3
    assert publish(spark.range(4), table, 1)
    assert read_published(spark, table).count() == 4
    assert prune_versions(spark, table, keep=1) == 1 and versions(spark, table) == [1]
