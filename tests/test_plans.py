"""Plan shapes that carry the scale design: with bounded per-run key sets the
gate does not shuffle the submissions and the upsert does not shuffle the
untouched stored results."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import frame
from lotgate.operators.rules import label_rows
from lotgate.operators.upsert import upsert_results
from lotgate.plans.migrate import migrate_history
from lotgate.plans.validate import stage_raw

HISTORY = [
    ("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "10"),
    ("B2", "Maker B", "9/3/2026", "P1", "U2", "Mix", "7"),
]


def physical(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_gate_is_broadcast_only(spark):
    model = migrate_history(frame(spark, HISTORY)).model
    up = frame(spark, [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "11", "f.csv"),
                       ("B3", "Maker A", "8/1/2026", "P1", "U1", "Temp", "1", "f.csv")],
               extra=["source_file"])
    plan = physical(label_rows(stage_raw(up, F.current_timestamp()), model))
    # No join or exchange partitions the submission rows by batch name; the
    # rows meet the per-batch verdict and every dimension by broadcast.
    assert "SortMergeJoin [Batch Name" not in plan
    assert "hashpartitioning(Batch Name" not in plan
    assert "BroadcastHashJoin [Batch Name" in plan
    assert plan.count("BroadcastHashJoin") >= 6


def test_upsert_keeps_untouched_results_unshuffled(spark):
    model = migrate_history(frame(spark, HISTORY)).model
    incoming = spark.createDataFrame([(1, 1, "11.0")], "batch_id long, parameter_id long, value string") \
        .withColumn("load_timestamp", F.current_timestamp())
    plan = physical(upsert_results(model["result"], incoming).next_state)
    assert "BroadcastHashJoin [batch_id" in plan and "LeftAnti" in plan
