"""History migration: one flat history frame to the six model tables (M-1, M-2).

Parents are inserted before children, each with insert-if-absent (U-1), so
the job can run on an empty or a populated model.  Rows with a NULL key part
are returned in ``skipped`` instead of creating NULL-named rows or vanishing
in an inner join (deliberate divergence D21).  The next state is checked for
key and NOT NULL violations among the inserted rows before it is returned (the
anti join already rules out clashes with stored rows, and foreign keys hold
by construction: every child id comes from an inner join to its parent), so a history
with conflicting batch metadata fails as it would in a transactional store.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotgate.functions.dates import parse_dom
from lotgate.functions.numbers import canonical_value
from lotgate.functions.text import strip_whitespace
from lotgate.operators.constraints import check_inserted
from lotgate.operators.lookups import bounded_broadcast, hierarchy_dim, lookup_manufacturer, lookup_unit_operation, resolve_keys
from lotgate.operators.upsert import insert_if_absent
from lotgate.plans.publish import Snapshot
from lotgate.schemas import MODEL_TABLES, empty_model
from lotgate.session import materialize, run_timestamp

KEY_NAMES = ["Batch Name", "Manufacturer", "Process", "Unit Operation", "Parameter"]

# Columns of the grouping-sets aggregate and the set each dimension needs.
ENTITY_COLS = ["Manufacturer", "Process", "Unit Operation", "Parameter", "Batch Name", "DoM"]
ENTITY_SETS = {
    "manufacturer": ("Manufacturer",),
    "process": ("Process",),
    "unit_operation": ("Process", "Unit Operation"),
    "parameter": ("Process", "Unit Operation", "Parameter"),
    "batch": ("Batch Name", "Manufacturer", "DoM"),
}


def _run_level(steps) -> None:
    """Run independent steps as concurrent Spark jobs (the scheduler accepts
    jobs from several driver threads); errors surface in the caller."""
    if len(steps) == 1:
        steps[0]()
        return
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for fut in [pool.submit(fn) for fn in steps]:
            fut.result()


def _grouping_id(group: tuple[str, ...]) -> int:
    """Spark's grouping id: one bit per column, set when it is aggregated away,
    the first column being the most significant bit."""
    gid = 0
    for c in ENTITY_COLS:
        gid = (gid << 1) | (0 if c in group else 1)
    return gid


def distinct_entities(src: DataFrame) -> DataFrame:
    """Every distinct entity set (A-6) in one scan and one shuffle: a
    grouping-sets aggregate tagged by grouping id."""
    return src.groupingSets([list(g) for g in ENTITY_SETS.values()], *ENTITY_COLS).agg(F.grouping_id().alias("_gid"))


def entity_rows(entities: DataFrame, name: str) -> DataFrame:
    """One entity set of :func:`distinct_entities`, in its own columns."""
    return entities.filter(F.col("_gid") == _grouping_id(ENTITY_SETS[name])).select(*ENTITY_SETS[name])


@dataclass
class Migration:
    model: dict[str, DataFrame]
    inserted: dict[str, DataFrame]
    skipped: DataFrame


def migrate_history(history: DataFrame, model: dict[str, DataFrame] | None = None,
                    run_ts: Column | None = None, check: bool = True) -> Migration:
    spark = history.sparkSession
    snapshot = model if isinstance(model, Snapshot) else None
    model = dict(model) if model is not None else empty_model(spark)
    ts = run_ts if run_ts is not None else run_timestamp(spark)

    src = history.withColumn("DoM", strip_whitespace(F.col("DoM"))) \
                 .withColumn("Value", canonical_value(F.col("Value")))
    # Written once: the rows are read for the entities, for heavy names and for the results.
    src = materialize(src, "history")
    complete = None
    for k in KEY_NAMES:
        c = F.col(k).isNotNull()
        complete = c if complete is None else complete & c
    skipped = src.filter(~complete)
    src = src.filter(complete)
    inserted: dict[str, DataFrame] = {}

    def step(name: str, candidates: DataFrame) -> None:
        res = insert_if_absent(name, model[name], candidates, run_ts=ts, max_id=snapshot.max_id(name) if snapshot else None)
        model[name] = res.next_state
        inserted[name] = res.inserted

    # Kept in the reliable checkpoint folder because each dimension step reads it.
    entities = materialize(distinct_entities(src), "entities")

    def entity(name: str) -> DataFrame:
        return entity_rows(entities, name)

    def manufacturers() -> None:
        step("manufacturer", entity("manufacturer").select(F.col("Manufacturer").alias("name")))

    def processes() -> None:
        step("process", entity("process").select(F.col("Process").alias("process_name")))

    def unit_operations() -> None:
        uo = entity("unit_operation")
        pid = model["process"].select(F.col("process_name").alias("_pn"), "process_id")
        step("unit_operation", uo.join(bounded_broadcast(pid), uo["Process"] == pid["_pn"])
             .select("process_id", F.col("Unit Operation").alias("unit_operation_name")))

    def parameters() -> None:
        step("parameter", lookup_unit_operation(entity("parameter"), model["process"],
                                                model["unit_operation"])
             .select("unit_operation_id", F.col("Parameter").alias("parameter_name")))

    def batches() -> None:
        step("batch", lookup_manufacturer(entity("batch"), model["manufacturer"]).select(
            F.col("Batch Name").alias("batch_name"), parse_dom(F.col("DoM")).alias("dom"),
            "manufacturer_id"))

    def results() -> None:
        hier = hierarchy_dim(model["process"], model["unit_operation"], model["parameter"])
        step("result", resolve_keys(src, model["batch"], hier).select(
            "batch_id", "parameter_id", F.col("Value").alias("value")))

    def hierarchy() -> None:
        unit_operations()
        parameters()

    # Parents before children; the steps of one level are independent and
    # are submitted as concurrent Spark jobs.
    for level in ([manufacturers, processes], [hierarchy, batches], [results]):
        _run_level(level)

    if check:
        check_inserted(inserted)
    return Migration(model, inserted, skipped)


def migration_summary(model: dict[str, DataFrame]) -> DataFrame:
    """Row count of each of the six model tables (M-2, A-1): of a store's
    snapshot from its commit log, without a scan."""
    if isinstance(model, Snapshot) and all(model.n_rows(name) is not None for name in MODEL_TABLES):
        return model.spark.createDataFrame([(name, model.n_rows(name)) for name in MODEL_TABLES], "table_name string, row_count long")
    parts = [
        model[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        for name in MODEL_TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
