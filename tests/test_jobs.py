"""The four jobs end to end on small CSV files: setup, history, validation, load."""

import os

import pytest

from lotgate.operators.constraints import DuplicateResultsError
from lotgate.plans.jobs import batch_load, batch_validation, history_migration, setup_store
from lotgate.plans.publish import ModelStore
from lotgate.session import scratch_path


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def write(folder, name, text):
    folder = local(folder)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


HISTORY = ("Batch Name,Manufacturer,DoM,Process,Unit Operation,Parameter,Value\n"
           "K1,Maker A,1/5/2026,Main,A,Time,40\n"
           "K1,Maker A,1/5/2026,Main,A,Flow,12\n"
           "K2,Maker B,2/6/2026,Main,B,Mix,300\n")


def test_four_jobs(spark):
    root = scratch_path(spark, "jobs")
    store = setup_store(spark, root)
    with pytest.raises(FileExistsError):
        setup_store(spark, root)
    hist = scratch_path(spark, "jobs-hist")
    write(hist, "history.csv", HISTORY)
    counts = {r.table_name: r.row_count for r in
              history_migration(spark, root, os.path.join(hist, "history.csv")).collect()}
    assert counts == {"manufacturer": 2, "process": 1, "unit_operation": 2, "parameter": 3,
                      "batch": 2, "result": 3, "skipped_history": 0}

    uploads = scratch_path(spark, "jobs-up")
    write(uploads, "t1.csv", "Batch Name,Process,Manufacturer,DoM,Unit Operation,Parameter,Value\r\n"
                             "K1,Main,Maker A,1/5/2026,A,Time,41\r\n"
                             "K3,Main,Maker B,3/7/2026,B,Mix,280\r\n"
                             "K4,Main,Maker C,3/7/2026,B,Mix,1\r\n")
    run = batch_validation(spark, root, uploads)
    assert run.result.counts.first().asDict() == {"total_records": 3, "rejected_records": 1,
                                                  "valid_records": 2}
    assert store.read("rejected_records").count() == 1
    assert store.read("stg_valid_records").count() == 2

    dry = batch_load(spark, root)                      # dry run
    assert dry.summary.first().asDict() == {"total_batches": 3, "total_results": 4}
    assert store.read("result").count() == 3
    batch_load(spark, root, commit=True)
    assert store.read("result").count() == 4
    assert {r.value for r in store.read("result").collect()} >= {"41.0", "280.0"}

    # A correction beside its original in the same folder is a duplicate (D20).
    write(uploads, "t2.csv", "Batch Name,Process,Manufacturer,DoM,Unit Operation,Parameter,Value\n"
                             "K1,Main,Maker A,1/5/2026,A,Time,42\n")
    batch_validation(spark, root, uploads)
    with pytest.raises(DuplicateResultsError):
        batch_load(spark, root, commit=True)
    assert store.read("result").count() == 4


def test_history_rows_that_cannot_be_stored_are_reported(spark):
    root = scratch_path(spark, "jobs-skipped")
    store = setup_store(spark, root)
    hist = scratch_path(spark, "jobs-skipped-hist")
    write(hist, "history.csv", HISTORY + "K9,,1/5/2026,Main,A,Time,1\n")
    counts = {r.table_name: r.row_count for r in history_migration(spark, root, os.path.join(hist, "history.csv")).collect()}
    assert counts["skipped_history"] == 1 and counts["result"] == 3
    assert store.read("skipped_history").first()["Batch Name"] == "K9"


def test_store_only_takes_a_missing_path_for_no_commit(spark):
    root = scratch_path(spark, "jobs-broken")
    store = setup_store(spark, root)
    folder = local(f"{root}/_commits") if "local" in globals() else f"{root}/_commits".removeprefix("file:")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "r+b") as fh:
                fh.truncate(10)
    with pytest.raises(Exception) as err:
        store.initialize()
    assert not isinstance(err.value, FileExistsError)


def test_history_with_a_line_end_inside_a_field(spark):
    """A quoted field over two lines is one parameter name, not half a record."""
    root = scratch_path(spark, "jobs-lines")
    setup_store(spark, root)
    hist = scratch_path(spark, "jobs-lines-hist")
    write(hist, "history.csv", HISTORY + 'K2,Maker B,2/6/2026,Main,B,"Temp\nhigh, ""max""",5\n')
    counts = {r.table_name: r.row_count for r in history_migration(spark, root, os.path.join(hist, "history.csv")).collect()}
    assert counts["parameter"] == 4 and counts["result"] == 4 and counts["skipped_history"] == 0
    names = {r.parameter_name for r in ModelStore(root, spark).read("parameter").collect()}
    assert names == {"Time", "Flow", "Mix", 'Temp\nhigh, "max"'}
