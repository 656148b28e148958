"""Small table helpers shared by the operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.session import materialize, scratch_path

__all__ = ["discard", "keep", "materialize", "partitions_for", "scratch_path", "word_count", "SPACE", "WORD"]

#: A word: a maximal run of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write *df* as Parquet in the shared checkpoint folder; the reread frame
    and its path (for :func:`discard`). It cuts lineage and survives lost
    executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark, *paths: str) -> None:
    """Delete handoff folders that no later step reads, and let go of the
    shuffle files of finished steps."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # Shuffle files go once the driver has collected the plans that made them.
    gc.collect()
    jvm.System.gc()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def partitions_for(spark, n_bytes: float, per_task: int = 16 << 20) -> int:
    """Tasks for *n_bytes* of shuffled data: the session's count at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_bytes // per_task) + 1)


def word_count(text: Column) -> Column:
    """Number of words of *text* (null: 0), without making an array of them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
