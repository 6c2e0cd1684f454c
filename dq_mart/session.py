"""Session construction and the shared work folder.

Jobs that materialise intermediate tables (landing, load audits, lineage
cuts) write under ``spark.checkpoint.dir``: on a cluster that setting names
a shared, fault-tolerant folder (HDFS / object store).  A private folder is
created only when the setting is absent *and* the master is local, as in
tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app: str = "dq_mart", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on.

    ANSI mode stays on (casts are written with ``try_*``); AQE is on so that
    join strategy, partition coalescing and skew splitting are decided at run
    time from real sizes.  Broadcast joins happen only below Spark's size
    threshold, checked by AQE on measured shuffle sizes.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints (lineage cuts) are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (also registered
    with the SparkContext, so ``DataFrame.checkpoint()`` writes there).

    Falls back to a fresh private folder only for a local master (tests,
    laptops); on a cluster a missing setting is an error rather than a
    silent machine-local path.
    """
    sc = spark.sparkContext
    root = (spark.conf.get(_CHECKPOINT_KEY, None)
            or sc.getConf().get(_CHECKPOINT_KEY, None))
    if root:
        root = root.rstrip("/")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            f"{_CHECKPOINT_KEY} is not set; point it at a shared folder")
    root = tempfile.mkdtemp(prefix="dq_mart-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, root)
    sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder; ``unique`` adds a run id so that
    concurrent runs never overwrite each other."""
    segs = ["dq_mart", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), *segs])


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder that goes when the driver ends."""
    path = shared_path(spark, "scratch", *parts)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side existence checks."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
