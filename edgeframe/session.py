"""Session settings and the shared scratch / checkpoint location.

Iterative operators cut lineage with reliable ``DataFrame.checkpoint()`` into
the folder the cluster names in ``spark.checkpoint.dir``.  Sinks that write and
read back (round-trip queries) put their files under the same shared folder.
A private folder is chosen only when the setting is absent *and* Spark runs in
local mode (tests, the bench); on a cluster a missing setting is an error,
because a machine-local temporary folder is not visible to other executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a local session (tests, bench).  AQE stays on so that
# skewed join partitions are split and tiny shuffles are coalesced at run time.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "edgeframe",
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session with a private checkpoint folder."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf["spark.driver.memory"] = os.environ.get("EDGEFRAME_DRIVER_MEMORY", "16g")
    # a private catalog location for a local run (otherwise ./spark-warehouse);
    # the checkpoint folder is left to the environment and only filled in by
    # checkpoint_dir() below when nothing names one
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="edgeframe-warehouse-")
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the master is local does it create a private folder (the test case).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; iterative operators and round-trip sinks "
                "need a folder shared by all executors (e.g. on HDFS or an object store)")
        conf = tempfile.mkdtemp(prefix="edgeframe-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
