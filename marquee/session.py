"""Session construction and the shared scratch location.

On a cluster the session comes from the platform; ``configure`` only fills
settings that are unset.  Scratch output (round trips, lineage cuts) goes
under ``spark.checkpoint.dir``, which a cluster points at shared storage;
a local directory is created only when nothing is configured (tests).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings for a large cluster (e.g. 100 TB on 1000 executors).

    Shuffle partitions start at ~3x the cores (AQE coalesces small ones), so
    each reducer holds a few hundred MB; skewed sort-merge partitions are
    split at 5x the median or 512 MB.
    """
    parts = max(200, 3 * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def build_session(master: str | None = None, app_name: str = "marquee",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_local_root: dict[str, str] = {}
_created_roots: list[str] = []


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; create a local one only if unset."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d
    key = spark.sparkContext.applicationId
    if key not in _local_root:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            _local_root[key] = existing
        else:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="marquee-ckpt-")
            spark.sparkContext.setCheckpointDir(root)
            _local_root[key] = root
            _created_roots.append(root)
    return _local_root[key]


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root (tracked for cleanup)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/marquee-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cleanup_scratch(spark: SparkSession) -> int:
    """Delete the scratch paths this process created (any Hadoop file system).

    Call it when the DataFrames read from them are no longer needed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _scratch:
        p = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def _remove_local_roots() -> None:
    # best effort at interpreter exit, only for local roots this module created
    import shutil
    for root in _created_roots:
        shutil.rmtree(root, ignore_errors=True)


atexit.register(_remove_local_roots)
