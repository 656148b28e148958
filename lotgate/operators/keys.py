"""Surrogate keys (K-1): new rows get ``max(existing id) + rank in key order``.

The rank is computed without a global window and without pulling rows to the
driver:

1. write the new rows once (unless they are a scan of a written table), so that
   the joins behind them run once and the range bounds are sampled from files;
2. range-partition the new keys and sort inside each partition, so partition
   ``i`` holds only keys below those of partition ``i + 1``;
3. tag every row with its partition and its position in the partition, and
   write the tagged rows as Parquet to the shared checkpoint folder, so a
   lost executor cannot renumber them;
4. count rows per partition (one small row per partition reaches the driver),
   turn the counts into starting offsets, and join them as a frame with a row
   per partition, so the plan does not grow with the partitions.

Because the keys are unique and the partitions are ordered, the id is the
global rank whatever the partition boundaries are, so a rerun over the same
input gives the same ids.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotgate.session import ensure_checkpoint_dir, materialize

_PART = "_k1_part"
_POS = "_k1_pos"
_BASE = "_k1_base"


def current_max(table: DataFrame, id_col: str) -> int:
    """The largest id in *table*, 0 when empty (one scalar to the driver)."""
    row = table.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0


def assign_keys(
    rows: DataFrame,
    key_cols: list[str],
    id_col: str,
    start_after: int = 0,
    num_partitions: int | None = None,
    after_max_of: DataFrame | None = None,
    written: bool = False,
) -> DataFrame:
    """Add *id_col* = ``start`` + 1-based rank of the row in key order.

    ``start`` is *start_after*, or the largest *id_col* in *after_max_of*
    when given as a frame (read in the same job as the partition sizes).  *rows* must be
    unique on *key_cols* (callers de-duplicate first).  The tagged rows are
    written once to the shared checkpoint folder, so the ids stay fixed.
    *written* says that *rows* only scan, filter and project a written table:
    they are read twice then and not written before.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    if not written:
        rows = materialize(rows, "new_keys")
    ordered = [F.col(k).asc_nulls_first() for k in key_cols]
    # Without an explicit count AQE sizes the range partitions from the data;
    # it only merges neighbouring ranges, so partition order stays key order.
    ranged = (rows.repartitionByRange(num_partitions, *ordered) if num_partitions
              else rows.repartitionByRange(*ordered))
    tagged = materialize(
        ranged
        .sortWithinPartitions(*ordered)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id()),
        "keys",
    )
    stats = tagged.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("n"), F.min(_POS).alias("p0"))
    if after_max_of is not None:
        # One extra row (partition -1) carries the current maximum id.
        stats = stats.unionByName(after_max_of.agg(
            F.lit(-1).alias(_PART), F.lit(0).cast("long").alias("n"),
            F.coalesce(F.max(id_col).cast("long"), F.lit(0).cast("long")).alias("p0")))
    sizes = {}
    for r in stats.collect():
        if r[_PART] == -1:
            start_after = int(r["p0"])
        else:
            sizes[r[_PART]] = (int(r["n"]), int(r["p0"]))
    width = max(sizes) + 1 if sizes else 1
    counts = [sizes.get(p, (0, 0))[0] for p in range(width)]
    before = [0] + list(accumulate(counts))[:-1]
    # id = position - first position of the partition + rows in earlier partitions.
    base = [start_after + 1 + before[p] - sizes.get(p, (0, 0))[1] for p in range(width)]
    offsets = spark.createDataFrame(pa.table({_PART: pa.array(range(width), pa.int32()), _BASE: pa.array(base, pa.int64())}))
    return tagged.join(F.broadcast(offsets), _PART).withColumn(id_col, F.col(_POS) + F.col(_BASE)).drop(_PART, _POS, _BASE)
