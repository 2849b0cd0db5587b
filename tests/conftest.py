import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import build_session
    ckpt = tempfile.mkdtemp(prefix="marquee-test-ckpt-")
    s = build_session("local[4]", app_name="marquee-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)


def bronze_df(spark, name, rows):
    """Bronze table from hand-written rows (raw text, NULL tokens applied)."""
    from marquee.schemas import BRONZE_SCHEMAS
    from marquee.sources.tsv import normalize_na
    return normalize_na(spark.createDataFrame(rows, BRONZE_SCHEMAS[name]))
