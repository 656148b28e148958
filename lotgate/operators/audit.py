"""Rejection audit and validation summary (R-1, R-2, U-4, A-2, A-3, A-8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.functions.audit import rejection_hash, row_json
from lotgate.operators.keys import assign_keys
from lotgate.operators.lookups import restrict_for_anti_join
from lotgate.operators.rules import INTERNAL
from lotgate.schemas import conform


def rejection_rows(staged: DataFrame) -> DataFrame:
    """Rejected staging rows as audit candidates: the row and its hash."""
    rej = staged.filter(F.col("is_rejected")).drop(*INTERNAL)
    return rej.withColumn("rejection_hash", rejection_hash())


@dataclass
class Audited:
    next_state: DataFrame
    inserted: DataFrame


def audit_rejections(staged: DataFrame, audit: DataFrame, run_ts: Column, max_id: int | None = None) -> Audited:
    """Insert rejected rows, ignoring any whose hash is already present,
    within this run or in the table (R-1, U-4).

    De-duplication is a hash aggregate keeping one row per hash, so many
    copies of one rejected row are combined map-side before the shuffle.  The
    row's JSON is written from its columns when the ids are there, so it is
    neither shuffled nor sorted.
    """
    candidates = rejection_rows(staged).dropDuplicates(["rejection_hash"])
    # The audit only grows; the hashes of this run are few, so the stored
    # hashes are filtered map-side by a broadcast of them (when bounded).
    known = restrict_for_anti_join(audit.select("rejection_hash"), "rejection_hash",
                                   candidates, "rejection_hash")
    fresh = candidates.join(known, "rejection_hash", "left_anti")
    with_ids = assign_keys(fresh, ["rejection_hash"], "rejected_id",
                           **({"after_max_of": audit} if max_id is None else {"start_after": max_id}))
    row = row_json(staged.drop(*INTERNAL))
    inserted = conform(with_ids.withColumns({"raw_data": row, "created_at": run_ts}), "rejected_records")
    return Audited(conform(audit, "rejected_records").unionByName(inserted), inserted)


def validation_counts(staged: DataFrame) -> DataFrame:
    """Total, rejected and valid rows in one pass (A-2)."""
    return staged.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_rejected")).alias("rejected_records"),
        F.count_if(~F.col("is_rejected")).alias("valid_records"),
    )


def rejections_by_stage(staged: DataFrame) -> DataFrame:
    """Rejected rows per stage, ordered by stage (A-3, O-1)."""
    return (
        staged.filter(F.col("is_rejected"))
        .groupBy("rejection_stage")
        .agg(F.count(F.lit(1)).alias("rejected_count"))
        .orderBy("rejection_stage")
    )
