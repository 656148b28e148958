"""Upload validation: staging, the rule gate, the audit and the valid set.

The labelled staging frame is evaluated once and reused by the audit, the
valid set and the summary (it is checkpointed to the reliable folder, which
is also what a later load job reads).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.functions.numbers import canonical_value
from lotgate.operators.audit import audit_rejections, rejections_by_stage, validation_counts
from lotgate.operators.constraints import check_inserted
from lotgate.operators.rules import label_rows
from lotgate.plans.publish import Snapshot
from lotgate.schemas import empty_table
from lotgate.session import materialize, run_timestamp


def stage_raw(submissions: DataFrame, load_ts: Column) -> DataFrame:
    """Every submitted row plus ``is_rejected``, ``rejection_stage`` and
    ``load_timestamp`` (S-8, P-3).  Values are put in canonical number text."""
    return submissions.withColumn("Value", canonical_value(F.col("Value"))).withColumns({
        "is_rejected": F.lit(False),
        "rejection_stage": F.lit(None).cast("string"),
        "load_timestamp": load_ts.cast("timestamp"),
    })


def stage_valid(staged: DataFrame) -> DataFrame:
    """Rows that passed every rule, staging columns only (S-9, P-4, P-8)."""
    return staged.filter(~F.col("is_rejected")).drop("rejection_rule")


@dataclass
class Validation:
    staged: DataFrame
    valid: DataFrame
    audit: DataFrame
    audit_inserted: DataFrame
    counts: DataFrame
    by_stage: DataFrame


def validate_uploads(submissions: DataFrame, model: dict[str, DataFrame],
                     run_ts: Column | None = None, persist: bool = True) -> Validation:
    """Run the gate over *submissions* against the stored *model*.

    ``model`` may hold ``rejected_records``; when absent the audit starts empty.
    """
    spark = submissions.sparkSession
    ts = run_ts if run_ts is not None else run_timestamp(spark)
    staged = label_rows(stage_raw(submissions, ts), model)
    if persist:
        staged = materialize(staged, "staged")
    audit_table = model.get("rejected_records")
    if audit_table is None:
        audit_table = empty_table(spark, "rejected_records")
    known = model.max_id("rejected_records") if isinstance(model, Snapshot) and "rejected_records" in model else None
    audited = audit_rejections(staged, audit_table, ts, known)
    check_inserted({"rejected_records": audited.inserted})
    return Validation(
        staged=staged,
        valid=stage_valid(staged),
        audit=audited.next_state,
        audit_inserted=audited.inserted,
        counts=validation_counts(staged),
        by_stage=rejections_by_stage(staged),
    )
