"""Session helpers: building a session for tests and finding the shared scratch folder.

On a cluster the session is built by the caller; the library only reads its settings. The one setting
we need is ``spark.checkpoint.dir``: a folder every executor can reach (HDFS, S3, ...). Lineage cuts and
intermediate tables are written under it. A folder of our own is set only when the session has none,
which is the case in tests and on ``local[*]``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "roomledger") -> SparkSession:
    """Session for tests and the bench. Cluster jobs pass their own session instead."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses ``spark.checkpoint.dir`` from the session. When it is unset, a local master gets a fresh folder under
    the system temp dir, recorded in the session; any other master raises, since executors could not read it.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="roomledger-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder (never reused, never cleaned here)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
