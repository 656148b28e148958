"""Recurring load of the valid staging rows (L-1, L-2, L-3, U-1 to U-3, J-4, J-10).

Order as in a transactional load: stop on duplicate batch/parameter input,
insert new batches, then update changed results and insert new ones (new
results see the batches of the same run).  The job returns the next state;
nothing is written unless the caller publishes it (a dry run is simply not
publishing, U-7).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotgate.functions.dates import parse_dom
from lotgate.operators.constraints import DuplicateResultsError, check_inserted, duplicate_results, has_rows
from lotgate.operators.lookups import bounded_broadcast, hierarchy_dim, lookup_manufacturer, resolve_keys
from lotgate.operators.upsert import insert_if_absent, upsert_results
from lotgate.plans.publish import Append, Buckets, Snapshot, bucket_of
from lotgate.schemas import MODEL_TABLES
from lotgate.session import materialize


#: The classified rows of the last published load.
CHANGES_TABLE = "load_changes"


@dataclass
class Load:
    model: dict[str, DataFrame]
    new_batches: DataFrame
    classified: DataFrame
    summary: DataFrame
    delta: dict  # what a publish of this load writes
    make_review: Callable[[], DataFrame] = field(repr=False)

    @cached_property
    def review(self) -> DataFrame:
        """Sized and planned when asked for: a load whose review nobody reads runs no job for it."""
        return self.make_review()


def new_batch_rows(valid: DataFrame, manufacturer: DataFrame) -> DataFrame:
    """Distinct (batch name, parsed DoM, manufacturer id, load time) of the valid rows (A-7)."""
    return lookup_manufacturer(valid, manufacturer).select(
        F.col("Batch Name").alias("batch_name"),
        parse_dom(F.col("DoM")).alias("dom"),
        "manufacturer_id",
        "load_timestamp",
    ).distinct()


def load_summary(model: dict[str, DataFrame], before: dict[str, DataFrame] | None = None,
                 inserted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Totals of batch and result after the load (L-2, A-1).

    Given the stored tables and the inserted rows, a total is the stored count
    plus the inserted count (updates never change a count): a store's commit
    log has the stored count, a bare count of a Parquet table reads only
    row-group metadata, and the inserted rows are few, so the large next state
    is never scanned for it.
    """
    if isinstance(before, Snapshot) and inserted is not None and None not in (before.n_rows("batch"), before.n_rows("result")):
        return inserted["batch"].agg(F.count(F.lit(1)).alias("b")).crossJoin(inserted["result"].agg(F.count(F.lit(1)).alias("r"))).select(
            (F.col("b") + before.n_rows("batch")).alias("total_batches"), (F.col("r") + before.n_rows("result")).alias("total_results"))
    if before is not None and inserted is not None:
        sources = {"batch": [before["batch"], inserted["batch"]],
                   "result": [before["result"], inserted["result"]]}
    else:
        sources = {"batch": [model["batch"]], "result": [model["result"]]}
    parts = []
    for name, frames in sources.items():
        mine, other = ("total_batches", "total_results") if name == "batch" else ("total_results", "total_batches")
        for df in frames:
            parts.append(df.agg(F.count(F.lit(1)).alias(mine)).withColumn(other, F.lit(0).cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.sum("total_batches").alias("total_batches"),
                   F.sum("total_results").alias("total_results"))


def review_loaded(model: dict[str, DataFrame], valid: DataFrame,
                  hier: DataFrame | None = None) -> DataFrame:
    """All stored results of the batches touched by *valid*, as names, sorted (L-3).

    The touched batches are found first (semi join on the distinct submitted
    names, J-10), so the large result table is joined only on their ids.
    """
    touched = model["batch"].join(
        valid.select(F.col("Batch Name").alias("batch_name")).distinct(), "batch_name", "left_semi")
    return _named_results(model, touched, hier)


def review_published(model: Snapshot) -> DataFrame:
    """The review of the last published load (L-3), from its change table: the
    results of every batch that the load named, as they are stored now, sorted.
    Of a bucketed table only the buckets of those batches are read."""
    ids = model[CHANGES_TABLE].select("batch_id").distinct()
    tables = {name: model[name] for name in MODEL_TABLES if name != "result"}
    if "result" in model.widths:
        bucket = bucket_of("batch_id", model.widths["result"]).alias("bucket")
        # At most a number per bucket, as the commit log has them.
        tables["result"] = model.buckets("result", only={r["bucket"] for r in ids.select(bucket).distinct().collect()})
    else:
        tables["result"] = model["result"]
    return _named_results(tables, tables["batch"].join(ids, "batch_id", "left_semi"))


def _named_results(model: dict[str, DataFrame], touched: DataFrame, hier: DataFrame | None = None) -> DataFrame:
    """The stored results of the batches *touched*, as names (J-4), sorted (O-3)."""
    touched = bounded_broadcast(touched)
    if hier is None:
        hier = hierarchy_dim(model["process"], model["unit_operation"], model["parameter"])
    hier = bounded_broadcast(hier)
    m = bounded_broadcast(model["manufacturer"].select("manufacturer_id", F.col("name").alias("manufacturer")))
    return (
        model["result"].select("batch_id", "parameter_id", "value", "created_at", "modified_at")
        .join(touched.select("batch_id", "batch_name", "dom", "manufacturer_id"), "batch_id")
        .join(m, "manufacturer_id")
        .join(hier, "parameter_id")
        .select(
            "batch_name", "dom", "manufacturer",
            F.col("process_name").alias("process"),
            F.col("unit_operation_name").alias("unit_operation"),
            F.col("parameter_name").alias("parameter"),
            "value", "created_at", "modified_at",
        )
        .orderBy("batch_name", "process", "unit_operation", "parameter")
    )


def recurring_load(valid: DataFrame, model: dict[str, DataFrame], check: bool = True) -> Load:
    """Load *valid* staging rows into *model*; raises on duplicate input.

    Given a store's snapshot, only the buckets of ``result`` that hold touched
    batches are read, and only those with new or updated rows are in ``delta``.
    """
    dups = duplicate_results(valid)
    if has_rows(dups):
        raise DuplicateResultsError(
            "Duplicate Batch/Parameter combinations in the valid staging rows; load stopped.", dups)
    before = model
    stored = model if isinstance(model, Snapshot) else None
    model = dict(model)

    # Written once: a large batch table is filtered by its names before it is joined.
    fresh = materialize(new_batch_rows(valid, model["manufacturer"]), "submitted_batches")
    batches = insert_if_absent("batch", model["batch"], fresh, ts_col="load_timestamp", max_id=stored.max_id("batch") if stored else None)
    model["batch"] = batches.next_state

    # Resolved once: the touched-batch split, the classification and the
    # insert all read it, and it carries the only shuffle of the submissions.
    hier = materialize(
        hierarchy_dim(model["process"], model["unit_operation"], model["parameter"]), "hierarchy")
    incoming = materialize(resolve_keys(valid, model["batch"], hier).select(
        "batch_id", "parameter_id", F.col("Value").alias("value"), "load_timestamp"), "incoming")
    if stored is not None and "result" in stored.widths:
        bucket = bucket_of("batch_id", stored.widths["result"]).alias("bucket")
        # At most a number per bucket, as the commit log has them.
        touched = {r["bucket"] for r in incoming.select(bucket).distinct().collect()}
        up = upsert_results(stored.buckets("result", only=touched), incoming, max_id=stored.max_id("result"))
        changed = {r["bucket"] for r in up.classified.where("action <> 'unchanged'").select(bucket).distinct().collect()}
        model["result"] = stored.buckets("result", but=touched).unionByName(up.next_state)
        result = Buckets(up.next_state.where(bucket_of("batch_id", stored.widths["result"]).isin(sorted(changed))), sorted(changed))
        reviewed = model | {"result": up.next_state}
    else:
        up = upsert_results(model["result"], incoming)
        model["result"] = result = up.next_state
        reviewed = model

    if check:
        check_inserted({"batch": batches.inserted, "result": up.inserted})
    return Load(
        model=model,
        new_batches=batches.inserted,
        classified=up.classified,
        summary=load_summary(model, before, {"batch": batches.inserted, "result": up.inserted}),
        delta={"batch": Append(batches.inserted), "result": result, CHANGES_TABLE: up.classified.select(
            "batch_id", "parameter_id", "action", "old_value", "value", "load_timestamp")},
        make_review=lambda: review_loaded(reviewed, valid, hier),
    )
