"""Session helpers: building a session for tests/bench and locating shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "citypulse",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Local/test session. On a cluster, the caller's session is used as is."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's own setting always wins; a private folder is only made when
    the session has none and runs in one process (``local[*]``): on a cluster
    other machines could not read it, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="citypulse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/citypulse-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Reliable checkpoint of a small derived table (an aggregate reused by
    several branches of a plan), so the large input behind it is read once.
    Written to the shared checkpoint folder; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` as a Parquet table in the shared folder: tables that several jobs read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
