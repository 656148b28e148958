"""The four intake jobs, each one all-or-nothing against a model store.

    setup_store        -> empty model tables; refuses to replace a store (S-12, S-13)
    history_migration  -> flat history file to the six tables (M-1, M-2)
    batch_validation   -> upload folder through the gate; audit, staging, valid set (R-1, R-2)
    batch_load         -> valid set into batch and result; dry run unless committed (L-1 to L-3, U-7)
    load_review        -> results of the batches of the last published load, sorted (L-3)
    verify_store       -> violated constraints of the stored tables (Q-1 to Q-3)

Validation and load share only the stored valid-staging table, as two
separate processes would.  Each job computes its whole next state first and
publishes it in one commit, or raises before anything is published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from lotgate.operators.constraints import constraint_report
from lotgate.plans.load import CHANGES_TABLE, Load, recurring_load, review_published
from lotgate.plans.migrate import migration_summary, migrate_history
from lotgate.plans.publish import Append, ModelStore
from lotgate.plans.reread import parsed_uploads
from lotgate.plans.validate import Validation, validate_uploads
from lotgate.schemas import MODEL_TABLES
from lotgate.session import materialize
from lotgate.sources.uploads import read_history, read_uploads

STAGING_TABLE = "stg_manufacturing_data"
VALID_TABLE = "stg_valid_records"
SKIPPED_TABLE = "skipped_history"


def setup_store(spark: SparkSession, root: str, reset: bool = False) -> ModelStore:
    store = ModelStore(root, spark)
    store.initialize(reset=reset)
    return store


def history_migration(spark: SparkSession, root: str, source: str,
                      run_ts: Column | None = None, multiline: bool = False) -> DataFrame:
    """Migrate one flat history file; returns the table counts (M-2) and, as
    ``skipped_history``, the number of rows that could not be stored.  Those
    rows are published under that name in the same commit."""
    store = ModelStore(root, spark)
    history = materialize(read_history(spark, source, multiline), "history")  # parsed once, read by several steps
    mig = migrate_history(history, store.read_model(), run_ts=run_ts)
    store.publish({**{k: Append(mig.inserted[k]) for k in MODEL_TABLES}, SKIPPED_TABLE: mig.skipped}, run_id="history")
    after = store.read_model()
    counts = migration_summary(after)
    return counts.unionByName(spark.createDataFrame([(SKIPPED_TABLE, after.n_rows(SKIPPED_TABLE))], counts.schema))


@dataclass
class ValidationRun:
    result: Validation
    run_id: str


def batch_validation(spark: SparkSession, root: str, upload_folder: str,
                     run_ts: Column | None = None, multiline: bool = False, reuse: bool = True) -> ValidationRun:
    """Validate every ``*.csv`` in *upload_folder* (the folder is re-read on
    every run, as the uploads are never moved); publish audit and staging.
    With *reuse* only new and changed files are parsed (:mod:`.reread`)."""
    store = ModelStore(root, spark)
    model = store.read_model()
    if reuse:
        parsed = parsed_uploads(spark, upload_folder, model, multiline)
        uploads, changes = parsed.rows, parsed.changes
    else:
        uploads, changes = materialize(read_uploads(spark, upload_folder, multiline), "uploads"), {}
    val = validate_uploads(uploads, model, run_ts=run_ts)
    run_id = store.publish({
        **changes,
        "rejected_records": Append(val.audit_inserted),
        STAGING_TABLE: val.staged.drop("rejection_rule"),
        VALID_TABLE: val.valid,
    }, run_id="validation")
    return ValidationRun(val, run_id)


def verify_store(spark: SparkSession, root: str) -> list[str]:
    """Every violated constraint of the published tables (Q-1 to Q-3): duplicate
    keys, NULLs in required columns, references without a parent.  The other
    jobs check what they insert; this reads the whole store."""
    return constraint_report(ModelStore(root, spark).read_model())


def batch_load(spark: SparkSession, root: str, commit: bool = False) -> Load:
    """Load the stored valid staging rows.  Without *commit* nothing is
    published (a dry run); duplicate input raises before any write."""
    store = ModelStore(root, spark)
    model = store.read_model()
    if VALID_TABLE not in model:
        raise KeyError(f"table {VALID_TABLE} has never been published in {root}")
    load = recurring_load(model[VALID_TABLE], model)  # one snapshot for both
    if commit:
        store.publish(load.delta, run_id="load")
    return load


def load_review(spark: SparkSession, root: str) -> DataFrame:
    """The review of the last published load, in a process of its own."""
    model = ModelStore(root, spark).read_model()
    if CHANGES_TABLE not in model:
        raise KeyError(f"no load has been published in {root}")
    return review_published(model)
