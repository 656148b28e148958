"""The upload folder as a file stream: each new file is validated and loaded once."""

import os

import pytest

from lotgate.plans.migrate import migrate_history
from lotgate.plans.publish import ModelStore
from lotgate.session import scratch_path
from lotgate.streaming.intake import IntakeLog, start_intake

from conftest import frame

HEADER = "Batch Name,Manufacturer,DoM,Process,Unit Operation,Parameter,Value\n"


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_stream_processes_each_file_once(spark):
    store = ModelStore(scratch_path(spark, "stream-store"), spark)
    history = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "10")]
    store.publish(migrate_history(frame(spark, history)).model, run_id="history")

    folder = local(scratch_path(spark, "stream-in"))
    os.makedirs(folder)
    with open(os.path.join(folder, "t1.csv"), "w") as fh:
        fh.write(HEADER + "B1,Maker A,8/1/2026,P1,U1,Temp,11\nB2,Nobody,8/1/2026,P1,U1,Temp,1\n")
    ckpt = scratch_path(spark, "stream-ckpt")
    log = IntakeLog()
    start_intake(spark, folder, store, ckpt, log=log).awaitTermination()
    assert [(e.files, e.total, e.rejected) for e in log.epochs] == [(1, 2, 1)]
    assert {r.value for r in store.read("result").collect()} == {"11.0"}
    assert store.read("rejected_records").count() == 1

    # A second file in a later run: only it is read.
    with open(os.path.join(folder, "t2.csv"), "w") as fh:
        fh.write("Value,Parameter,Unit Operation,Process,DoM,Manufacturer,Batch Name\n"
                 "12,Temp,U1,P1,8/1/2026,Maker A,B3\n")
    start_intake(spark, folder, store, ckpt, log=log).awaitTermination()
    assert [e.files for e in log.epochs] == [1, 1]
    assert store.read("batch").count() == 2 and store.read("result").count() == 2


def test_file_count_does_not_change_labels(spark):
    """Two files that contradict each other about B9, and two that hold the
    same batch and parameter, give what one folder run gives."""
    history = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "10")]
    store = ModelStore(scratch_path(spark, "stream-store"), spark)
    store.publish(migrate_history(frame(spark, history)).model, run_id="history")
    folder = local(scratch_path(spark, "stream-in"))
    os.makedirs(folder)
    for i, day in enumerate(("8/1/2026", "9/1/2026")):
        with open(os.path.join(folder, f"c{i}.csv"), "w") as fh:
            fh.write(HEADER + f"B9,Maker A,{day},P1,U1,Temp,1\n")
    log = IntakeLog()
    ckpt = scratch_path(spark, "stream-ckpt")
    start_intake(spark, folder, store, ckpt, log=log).awaitTermination()
    assert [(e.files, e.total, e.rejected) for e in log.epochs] == [(2, 2, 2)]

    for i in range(2):
        with open(os.path.join(folder, f"d{i}.csv"), "w") as fh:
            fh.write(HEADER + f"B8,Maker A,8/1/2026,P1,U1,Temp,{i}\n")
    with pytest.raises(Exception, match="submitted more than once|[Dd]uplicate"):
        start_intake(spark, folder, store, ckpt, log=log).awaitTermination()
    assert store.read("batch").count() == 1
    # The way out: leave one of them out.
    start_intake(spark, folder, store, ckpt, log=log, exclude={"d1.csv"}).awaitTermination()
    assert store.read("batch").count() == 2 and {r.value for r in store.read("result").collect()} == {"10.0", "0.0"}
