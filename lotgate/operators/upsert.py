"""Insert-if-absent and change-classifying upsert (U-1, U-2, U-3, J-11).

Plain Parquet has no UPDATE or MERGE, so each operator returns the *next
state* of the table plus what changed; only ``lotgate.plans.publish`` writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.functions.numbers import values_differ
from lotgate.operators.keys import assign_keys
from lotgate.operators.lookups import fits_broadcast, restrict_for_anti_join
from lotgate.schemas import GROWING_TABLES, KEYS, conform
from lotgate.session import materialize


@dataclass
class Inserted:
    next_state: DataFrame
    inserted: DataFrame


def _timestamps(df: DataFrame, ts: Column) -> DataFrame:
    return df.withColumn("created_at", ts).withColumn("modified_at", ts)


def _after(table: DataFrame, max_id: int | None) -> dict:
    return {"after_max_of": table} if max_id is None else {"start_after": max_id}


def insert_if_absent(
    table_name: str,
    table: DataFrame,
    candidates: DataFrame,
    run_ts: Column | None = None,
    ts_col: str | None = None,
    max_id: int | None = None,
) -> Inserted:
    """Append the candidates whose business key is not in *table* (U-1).

    Keys match with ``=`` as in ``NOT EXISTS``, so a NULL key part never
    matches.  New rows get ids after the current maximum (K-1; *max_id* if the
    caller knows it, else read from the table) and
    ``created_at = modified_at`` = *run_ts* or the candidate's *ts_col*.
    """
    keys = KEYS[table_name]
    bk = list(keys.business_key)
    stored = table
    if table_name in GROWING_TABLES and len(bk) == 1:
        # Tables that grow with the data (batch) are filtered map-side by a
        # broadcast of the candidate keys when those are bounded, so the anti
        # join stays small; reference dimensions are joined as they are.
        stored = restrict_for_anti_join(table, bk[0], candidates, bk[0])
    existing = stored.select(*[F.col(k).alias(f"_x_{k}") for k in bk])
    cond = None
    for k in bk:
        c = candidates[k] == existing[f"_x_{k}"]
        cond = c if cond is None else cond & c
    fresh = candidates.join(existing, cond, "left_anti")
    with_ids = assign_keys(fresh, bk, keys.id_col, **_after(table, max_id))
    ts = F.col(ts_col) if ts_col else run_ts
    inserted = conform(_timestamps(with_ids, ts), table_name)
    return Inserted(conform(table, table_name).unionByName(inserted), inserted)


@dataclass
class Upserted:
    next_state: DataFrame
    classified: DataFrame
    inserted: DataFrame


def classify_results(result: DataFrame, incoming: DataFrame) -> DataFrame:
    """Label each incoming (batch_id, parameter_id, value) as new, updated or
    unchanged against the stored results (U-3); *incoming* is unique on the key."""
    stored = result.select(
        "batch_id", "parameter_id", "result_id", F.col("value").alias("old_value"))
    joined = incoming.join(stored, ["batch_id", "parameter_id"], "left")
    action = (
        F.when(F.col("result_id").isNull(), F.lit("new"))
        .when(values_differ(F.col("old_value"), F.col("value")), F.lit("updated"))
        .otherwise(F.lit("unchanged"))
    )
    return joined.withColumn("action", action)


def _apply_changes(stored: DataFrame, classified: DataFrame, ts_col: str) -> DataFrame:
    """Stored rows with updated values and ``modified_at`` where classified 'updated'."""
    changes = classified.filter(F.col("action") == "updated").select(
        "batch_id", "parameter_id", F.col("value").alias("_new_value"),
        F.col(ts_col).alias("_new_ts"), F.lit(True).alias("_changed"))
    return (
        conform(stored, "result")
        .join(changes, ["batch_id", "parameter_id"], "left")
        .withColumn("value", F.when(F.col("_changed"), F.col("_new_value")).otherwise(F.col("value")))
        .withColumn("modified_at", F.when(F.col("_changed"), F.col("_new_ts")).otherwise(F.col("modified_at")))
    )


def upsert_results(result: DataFrame, incoming: DataFrame, ts_col: str = "load_timestamp",
                   max_id: int | None = None) -> Upserted:
    """Update changed values and insert new results (U-2 + U-1 on result).

    *incoming* has batch_id, parameter_id, value and *ts_col*.  Updated rows
    take the new value and ``modified_at`` = *ts_col*; new rows get ids after
    the current maximum (*max_id* if the caller knows it).  The classified rows
    are written once: the updates, the inserts and the caller read them.

    A load touches few batches of a large result table.  When the touched
    batch ids fit the broadcast bound, stored results are split map-side
    (broadcast semi / anti join): untouched ones pass through unshuffled and
    only touched ones are joined with the incoming rows.  Beyond the bound,
    one shuffle join of the whole table is used.
    """
    touched = incoming.select("batch_id").distinct()
    if fits_broadcast(touched):
        ids = F.broadcast(touched)
        stored = result.join(ids, "batch_id", "left_semi")
        untouched = conform(result.join(ids, "batch_id", "left_anti"), "result")
    else:
        stored, untouched = result, None
    classified = materialize(classify_results(stored, incoming), "classified")
    kept = conform(_apply_changes(stored, classified, ts_col), "result")
    if untouched is not None:
        kept = untouched.unionByName(kept)
    fresh = classified.filter(F.col("action") == "new").select(
        "batch_id", "parameter_id", "value", ts_col)
    with_ids = assign_keys(fresh, ["batch_id", "parameter_id"], "result_id", written=True,
                           **_after(result, max_id))
    inserted = conform(_timestamps(with_ids, F.col(ts_col)), "result")
    return Upserted(kept.unionByName(inserted), classified, inserted)
