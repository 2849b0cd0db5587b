"""Loading text: columns by header name, malformed rows, manifests and observed counts."""

import gzip
import os

import pytest

from marquee.schemas import STRICT_NA_TOKENS
from marquee.sources import tsv
from marquee.sources.refresh import is_fresh, load_options, refresh_bronze

HEADER = "tconst\taverageRating\tnumVotes\n"


def _file(path, text, zipped=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open(path, "wt") if zipped else open(path, "w")) as f:
        f.write(text)
    return str(path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_by_name_in_any_order_with_others_ignored(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv", "numVotes\tnote\taverageRating\ttconst\n100\tx\t7.5\ttt1\n")
    assert _rows(tsv.read_tsv(spark, p, "title_ratings")) == [("tt1", 7.5, 100)]


def test_missing_column_is_an_error(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv", "numVotes\ttconst\n100\ttt1\n")
    with pytest.raises(ValueError, match="lacks averageRating"):
        tsv.read_tsv(spark, p, "title_ratings")
    with pytest.raises(ValueError, match="no columns"):
        tsv.read_tsv(spark, _file(f"{tmp_out}/b/empty.tsv", ""), "title_ratings")


def test_files_with_differing_headers_do_not_mix(spark, tmp_out):
    _file(f"{tmp_out}/a/1.tsv", HEADER + "tt1\t7.5\t100\n")
    _file(f"{tmp_out}/a/2.tsv", "averageRating\ttconst\tnumVotes\n7.5\ttt2\t100\n")
    with pytest.raises(Exception, match="(?i)header"):
        tsv.read_tsv(spark, f"{tmp_out}/a", "title_ratings").collect()


BAD = HEADER + "tt1\t7.5\t100\ntt2\ntt3\t8\t5\textra\ntt4\thigh\t3\ntt5\t\\N\tNA\ntt6\t6\t1.5\n"


def test_bad_rows_are_marked_with_their_reason(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv", BAD)
    assert _rows(tsv.scan_tsv(spark, p, "title_ratings")) == [
        ("tt1", 7.5, 100, None), ("tt2", None, None, "fields"), ("tt3", 8.0, 5, "fields"),
        ("tt4", None, 3, "type:averageRating"), ("tt5", None, None, None), ("tt6", 6.0, None, "type:numVotes")]


def test_marks_do_not_depend_on_the_columns_read(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv", BAD)
    rows = tsv.scan_tsv(spark, p, "title_ratings")
    assert rows.filter("bad_row = 'fields'").count() == 2
    assert rows.select("tconst").count() == 6 and rows.filter("bad_row IS NULL").count() == 2


@pytest.mark.parametrize("policy,n", [("null", 6), ("drop", 2)])
def test_policies(spark, tmp_out, policy, n):
    p = _file(f"{tmp_out}/a/r.tsv", BAD)
    assert tsv.read_tsv(spark, p, "title_ratings", bad_rows=policy).count() == n


def test_fail_policy_names_the_row(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv", BAD)
    with pytest.raises(Exception, match="malformed row, tconst tt2: fields"):
        tsv.read_tsv(spark, p, "title_ratings", bad_rows="fail").collect()
    with pytest.raises(ValueError, match="unknown policy"):
        tsv.read_tsv(spark, p, "title_ratings", bad_rows="maybe")
    good = _file(f"{tmp_out}/b/r.tsv", HEADER + "tt1\t7.5\t100\n")
    assert _rows(tsv.read_tsv(spark, good, "title_ratings", bad_rows="fail")) == [("tt1", 7.5, 100)]


@pytest.mark.parametrize("policy,rows,nulls", [("null", 6, 6), ("drop", 2, 2)])
def test_report_counts_are_those_of_the_written_table(spark, tmp_out, policy, rows, nulls):
    src = {"title_ratings": _file(f"{tmp_out}/a/r.tsv.gz", BAD, True)}
    r = refresh_bronze(spark, src, f"{tmp_out}/t", bad_rows=policy).first()
    assert (r.ok, r.skipped, r.rows, r.bad_rows, r.null_values, r.error) == (True, False, rows, 4, nulls, None)
    assert spark.read.parquet(f"{tmp_out}/t/title_ratings").count() == rows


def test_fail_policy_is_reported_and_loads_nothing(spark, tmp_out):
    src = {"title_ratings": _file(f"{tmp_out}/a/r.tsv", BAD)}
    r = refresh_bronze(spark, src, f"{tmp_out}/t", bad_rows="fail").first()
    assert not r.ok and "malformed row" in r.error and r.rows is None
    assert not is_fresh(spark, src["title_ratings"], f"{tmp_out}/t/title_ratings",
                        load_options("title_ratings", bad_rows="fail"))


def test_freshness_is_that_of_every_file_and_option(spark, tmp_out):
    root = f"{tmp_out}/landing"
    _file(f"{root}/x/y/1.tsv", HEADER + "tt1\t7.5\t100\n")
    _file(f"{root}/2.tsv", HEADER + "tt2\t7.5\t100\n")
    src, t = {"title_ratings": root}, f"{tmp_out}/t"
    step = lambda **how: (lambda r: (r.skipped, r.forced, r.rows))(refresh_bronze(spark, src, t, **how).first())
    assert step() == (False, False, 2)
    assert step() == (True, False, 2)
    assert step(force=True) == (False, True, 2)
    p = _file(f"{root}/x/y/1.tsv", HEADER + "tt1\t7.5\t100\ntt3\t1\t1\n")      # a nested file changes
    assert step() == (False, False, 3) and step() == (True, False, 3)
    st = os.stat(p)
    os.utime(p, (st.st_atime - 5000, st.st_mtime - 5000))                       # older than the target, still another file
    assert step() == (False, False, 3)
    _file(f"{root}/z/3.tsv", HEADER)                                            # a file without rows is added
    assert step() == (False, False, 3)
    os.remove(f"{root}/2.tsv")                                                  # and one goes
    assert step() == (False, False, 2)
    assert step(na_tokens=STRICT_NA_TOKENS) == (False, False, 2)
    assert step(na_tokens=STRICT_NA_TOKENS) == (True, False, 2)


def test_load_that_ended_before_its_manifest_is_done_again(spark, tmp_out):
    import shutil
    src = {"title_ratings": _file(f"{tmp_out}/a/r.tsv", HEADER + "tt1\t7.5\t100\n")}
    refresh_bronze(spark, src, f"{tmp_out}/t").collect()
    shutil.rmtree(f"{tmp_out}/t/title_ratings.manifest")
    assert not refresh_bronze(spark, src, f"{tmp_out}/t").first().skipped


def test_gzip_rows_are_spread(spark, tmp_out):
    p = _file(f"{tmp_out}/a/r.tsv.gz", HEADER + "".join(f"tt{i}\t7\t1\n" for i in range(5000)), True)
    df = tsv.read_tsv(spark, p, "title_ratings", min_partitions=4)
    assert df.count() == 5000 and "RoundRobinPartitioning(4)" in df._jdf.queryExecution().toString()
