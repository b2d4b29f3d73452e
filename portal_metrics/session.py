"""Spark session helpers.

Library code never creates its own session; it takes the caller's.  The
helpers here exist for tests, the bench and the command-line load job.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; the broadcast threshold is the
# planner's own size check for joins that carry no explicit hint.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "portal_metrics", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a fresh scratch
    folder is taken.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if cur:
        return cur
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="pm-ckpt-", dir=os.environ.get("PM_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, inside the shared
    checkpoint folder (never a machine-local temp folder on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` written as Parquet in the shared scratch folder and read back: its lineage is cut, and it is computed once
    however many branches of a report read it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
