"""Session helpers: a local session for tests and a shared scratch folder.

On a cluster the session comes from the caller and ``spark.checkpoint.dir``
names a shared folder; we only fill it in when it is unset (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lotgate")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Checkpoint files of frames no longer referenced are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # With the V2 Parquet reader, max(id) and counts come from footers.
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # a client session: the cluster must name a shared folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lotgate-ckpt-"))
    else:  # executors elsewhere cannot see a folder of this machine
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for handoff tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "lotgate", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write *df* as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` and survives lost executors, and
    the result is a columnar table: later reads prune columns, push filters
    down and carry file-size statistics, so the planner's own size check can
    broadcast small tables.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_timestamp(spark: SparkSession) -> Column:
    """The job's timestamp, read once and returned as a literal (F-9).

    A bare ``current_timestamp()`` would be re-evaluated each time a lazy
    next state is read; the source system stamps a whole transaction with one
    time, so the value is fixed here, in the session time zone.
    """
    text = spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]
    return F.to_timestamp(F.lit(text), "yyyy-MM-dd HH:mm:ss.SSSSSS")
