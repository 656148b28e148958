"""The ordered rule gate (V-0 to V-8).

The source system applies eight ``UPDATE ... WHERE is_rejected = FALSE AND
<rule>`` statements in order.  Only rule 3 (metadata conflicts inside the
upload) looks at other rows, and it depends only on rules 1 and 2; rules 4 to
8 read the row and the stored tables.  So the gate is one pass:

* rules 1 and 2 are row expressions;
* rule 3 is one aggregate per batch name over the survivors of rules 1-2
  (partial aggregation before the shuffle, so a huge batch is no hot task);
* rule 4 needs the stored batch row: the per-batch aggregate is joined to the
  batch table (one row per batch on both sides), then the per-batch verdict
  is joined back to the rows once.  When the upload names few enough batches
  (the usual case: one upload against a large history) the batch table is
  filtered map-side by a broadcast of those names and the verdict is
  broadcast back, so neither the submissions nor the batch table shuffle;
  otherwise both joins are shuffle joins (AQE splits a hot batch);
* rules 5 to 8 are left joins to unique-key reference dimensions, broadcast
  behind a size check;
* the label is the first rule that fires.

No staging rewrite happens; the frame is evaluated once by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.functions.dates import parse_dom
from lotgate.functions.text import is_blank, trim_spaces
from lotgate.operators.lookups import (
    bounded_broadcast_all, fits_broadcast, hierarchy_dim, restrict_to_keys, spread_join, unit_operation_dim,
)
from lotgate.session import materialize

# The stage labels, in rule order; rules 3 and 4 share a label.
STAGE_LABELS = [
    "batch_name", "dom", "batch_metadata", "batch_metadata",
    "manufacturer", "process", "unit_operation", "parameter",
]
# Internal rule ids (one per rule) so the shared label can be told apart.
RULE_IDS = [
    "batch_name", "dom", "upload_metadata", "stored_metadata",
    "manufacturer", "process", "unit_operation", "parameter",
]

# Columns added by the gate that are internal and not part of the staging row.
INTERNAL = ["rejection_rule"]


def _rule_columns(s: DataFrame) -> list[Column]:
    """The eight rule predicates over the joined frame, in order."""
    r1 = is_blank(F.col("Batch Name"))
    r2 = F.col("_dom").isNull()
    r3 = F.coalesce(F.col("_conflict"), F.lit(False))
    r4 = (
        F.col("_b_found").isNotNull()
        & F.col("_mid").isNotNull()
        & (~F.col("_b_dom").eqNullSafe(F.col("_dom")) | ~F.col("_b_mid").eqNullSafe(F.col("_mid")))
    )
    r5 = F.col("_mid").isNull()
    r6 = F.col("_p_found").isNull()
    r7 = F.col("_u_found").isNull()
    r8 = F.col("_h_found").isNull()
    return [r1, r2, r3, r4, r5, r6, r7, r8]


def upload_conflicts(rows: DataFrame) -> DataFrame:
    """Batch names whose surviving rows disagree on trimmed DoM or Manufacturer (A-5).

    ``COUNT(DISTINCT x) > 1`` ignoring NULL is ``min <> max``, which needs one
    partial aggregate and no Expand.  The least and greatest are those of two
    64-bit hashes of the text, so the buffers have a fixed width and the plan a
    hash aggregate: texts whose hashes differ differ, and different texts go
    unseen only if 128 bits of hash agree.
    """
    tests = []
    texts = rows.select("Batch Name", *[trim_spaces(F.col(name)).alias(name) for name in ("DoM", "Manufacturer")])
    for name in ("DoM", "Manufacturer"):
        text = F.col(name)
        for seed in (1, 2):
            mark = F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text))
            tests.append(F.coalesce(F.min(mark) != F.max(mark), F.lit(False)))
    conflict = tests[0]
    for t in tests[1:]:
        conflict = conflict | t
    return texts.groupBy("Batch Name").agg(conflict.alias("_conflict"))


def survivors_of_row_rules(staging: DataFrame) -> Column:
    return ~is_blank(F.col("Batch Name")) & parse_dom(F.col("DoM")).isNotNull()


def label_rows(staging: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """Add ``is_rejected``, ``rejection_stage`` and ``rejection_rule`` (V-0).

    *staging* holds the submission columns (as text) plus ``source_file`` and
    ``load_timestamp``; *model* holds the stored ``batch``, ``manufacturer``,
    ``process``, ``unit_operation`` and ``parameter`` tables.
    """
    cols = staging.columns
    # Written once: the rows are read for the conflicts, for heavy names and for the labels.
    s = materialize(staging.withColumn("_dom", parse_dom(F.col("DoM"))), "submissions")

    # Rule 3 over the survivors of rules 1-2, then rule 4's stored batch row,
    # combined per batch name before touching the rows again.
    surv = s.filter(~is_blank(F.col("Batch Name")) & F.col("_dom").isNotNull())
    # One row per surviving batch name, partially aggregated before its
    # shuffle and kept in the checkpoint folder (the rows are read once more).
    conflicts = materialize(upload_conflicts(surv), "conflicts")
    small = fits_broadcast(conflicts)
    batch = model["batch"]
    if small:
        # Only the stored batches this upload names, filtered map-side.
        batch = F.broadcast(restrict_to_keys(batch, "batch_name", conflicts, "Batch Name", small=True))
    stored = batch.select(
        F.col("batch_name").alias("_b_name"), F.lit(True).alias("_b_found"),
        F.col("dom").alias("_b_dom"), F.col("manufacturer_id").alias("_b_mid"))
    per_batch = conflicts.join(
        stored, conflicts["Batch Name"] == stored["_b_name"], "left"
    ).drop("_b_name").withColumnRenamed("Batch Name", "_pb_name")
    if small:
        # The verdict goes to the rows by broadcast: the submissions are not shuffled.
        per_batch = F.broadcast(per_batch)
        s = s.join(per_batch, s["Batch Name"] == per_batch["_pb_name"], "left").drop("_pb_name")
    else:
        s = spread_join(s, "Batch Name", per_batch, "_pb_name")

    # Rules 5-8: unique-key reference dimensions, sized together in one job.
    m, p, u, h = bounded_broadcast_all([
        model["manufacturer"].select(
            F.col("name").alias("_m_name"), F.col("manufacturer_id").alias("_mid")),
        model["process"].select(
            F.col("process_name").alias("_p_name"), F.lit(True).alias("_p_found")),
        unit_operation_dim(model["process"], model["unit_operation"]).select(
            F.col("process_name").alias("_u_p"), F.col("unit_operation_name").alias("_u_n"),
            F.lit(True).alias("_u_found")),
        hierarchy_dim(model["process"], model["unit_operation"], model["parameter"]).select(
            F.col("process_name").alias("_h_p"), F.col("unit_operation_name").alias("_h_u"),
            F.col("parameter_name").alias("_h_n"), F.lit(True).alias("_h_found")),
    ])
    s = s.join(m, s["Manufacturer"] == m["_m_name"], "left").drop("_m_name")
    s = s.join(p, s["Process"] == p["_p_name"], "left").drop("_p_name")
    s = s.join(u, (s["Process"] == u["_u_p"]) & (s["Unit Operation"] == u["_u_n"]), "left") \
        .drop("_u_p", "_u_n")
    s = s.join(h, (s["Process"] == h["_h_p"]) & (s["Unit Operation"] == h["_h_u"])
               & (s["Parameter"] == h["_h_n"]), "left").drop("_h_p", "_h_u", "_h_n")

    # The rules are tried once a row; label and id follow from the first that fires.
    first = F.lit(None).cast("int")
    for i, pred in reversed(list(enumerate(_rule_columns(s)))):
        first = F.when(pred, F.lit(i)).otherwise(first)
    s = s.withColumn("_first", first)
    stage = F.lit(None).cast("string")
    rule = F.lit(None).cast("string")
    for i, (label, rid) in enumerate(zip(STAGE_LABELS, RULE_IDS)):
        stage = F.when(F.col("_first") == i, F.lit(label)).otherwise(stage)
        rule = F.when(F.col("_first") == i, F.lit(rid)).otherwise(rule)
    out_cols = [c for c in cols if c not in ("is_rejected", "rejection_stage", "load_timestamp")]
    return s.select(
        *[F.col(c) for c in out_cols],
        F.col("_first").isNotNull().alias("is_rejected"),
        stage.alias("rejection_stage"),
        F.col("load_timestamp"),
        rule.alias("rejection_rule"),
    )


def rule_hits(labeled: DataFrame, rule_id: str) -> DataFrame:
    """Rows whose first failing rule is *rule_id* (V-1 to V-8)."""
    return labeled.filter(F.col("rejection_rule") == rule_id)
