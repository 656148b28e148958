"""The store: appended folders, buckets that are neither read nor written,
counts and ids from the commit log."""

import os

import pytest
from conftest import frame

from lotgate.plans.jobs import load_review
from lotgate.plans.load import CHANGES_TABLE, recurring_load
from lotgate.plans.migrate import migrate_history, migration_summary
from lotgate.plans.publish import Append, Buckets, ModelStore
from lotgate.plans.validate import validate_uploads
from lotgate.schemas import KEYS, MODEL_TABLES, conform
from lotgate.session import run_timestamp, scratch_path


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def history(n):
    return [(f"H{i:03d}", "Maker", "1/5/2026", "Main", "A", p, str(i)) for i in range(n) for p in ("Time", "Flow")]


@pytest.fixture
def store(spark):
    spark.conf.set("lotgate.result.bucketBatches", "10")
    store = ModelStore(scratch_path(spark, "store-test"), spark)
    store.initialize()
    mig = migrate_history(frame(spark, history(40)), store.read_model())
    store.publish({k: Append(mig.inserted[k]) for k in MODEL_TABLES}, run_id="history")
    yield store
    spark.conf.unset("lotgate.result.bucketBatches")


def submit(spark, store, rows):
    rows = frame(spark, [(*r, "u.csv") for r in rows], extra=["source_file"])
    val = validate_uploads(rows, store.read_model())
    return val, recurring_load(val.valid, store.read_model())


def files_of(paths):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p in map(local, paths) for f in os.listdir(p)}


def rows_of(table):
    return sorted(tuple(r) for r in table.collect())


def test_untouched_buckets_are_neither_read_nor_written(spark, store):
    before = store.read_model()
    assert before.widths == {"result": 10} and before.n_rows("result") == 80 and before.max_id("result") == 80 == before["result"].count()
    paths = {p.rsplit("=", 1)[1]: p for p in before.paths("result")}
    assert sorted(map(int, paths)) == [0, 1, 2, 3, 4]  # ids 1 to 40
    val, load = submit(spark, store, [("H012", "Maker", "1/5/2026", "Main", "A", "Time", "99"),   # id 13: updated
                                      ("H022", "Maker", "1/5/2026", "Main", "A", "Time", "22"),   # id 23: unchanged
                                      ("N1", "Maker", "1/6/2026", "Main", "A", "Time", "7")])    # id 41: new
    # What the load read of result lies in the touched buckets only.
    read = {p.rsplit("/", 1)[0].rsplit("=", 1)[1] for p in load.review.inputFiles() if "/result/bucket=" in p}
    assert read == {"1", "2", "4"}
    assert isinstance(load.delta["result"], Buckets) and load.delta["result"].touched == [1, 4]
    assert load.summary.first().asDict() == {"total_batches": 41, "total_results": 81}
    stamps = files_of(before.paths("result"))
    expected = rows_of(conform(load.model["result"], "result"))
    run = store.publish(load.delta, run_id="load")
    after = store.read_model()
    now = {p.rsplit("=", 1)[1]: p for p in after.paths("result")}
    assert [b for b in now if now[b] != paths[b]] == [b for b in now if run in now[b]] and {b for b in now if run in now[b]} == {"1", "4"}
    assert files_of(before.paths("result")) == stamps
    assert rows_of(after["result"]) == expected and after.n_rows("result") == 81 and after.max_id("result") == 81
    values = {(r["batch_id"], r["parameter_id"]): r["value"] for r in after["result"].collect()}
    assert "99.0" in values.values() and len(values) == 81
    # The same submission again changes nothing and writes no bucket.
    _, again = submit(spark, store, [("H012", "Maker", "1/5/2026", "Main", "A", "Time", "99")])
    assert again.delta["result"].touched == [] and {r["action"] for r in again.classified.collect()} == {"unchanged"}
    store.publish(again.delta, run_id="load")
    assert store.read_model().paths("result") == after.paths("result") and rows_of(store.read("result")) == expected


def test_review_is_built_when_asked_for_and_again_from_the_change_table(spark, store):
    _, load = submit(spark, store, [("H012", "Maker", "1/5/2026", "Main", "A", "Time", "99"),
                                    ("H022", "Maker", "1/5/2026", "Main", "A", "Time", "22"),
                                    ("N1", "Maker", "1/6/2026", "Main", "A", "Time", "7")])
    assert "review" not in vars(load)
    expected = [tuple(r) for r in load.review.collect()]
    with pytest.raises(KeyError):
        load_review(spark, store.root)
    store.publish(load.delta, run_id="load")
    review = load_review(spark, store.root)
    got = [tuple(r) for r in review.collect()]
    assert got == expected and len(got) == 5  # both results of H012 and H022, one of N1
    assert [r[0] for r in got] == ["H012", "H012", "H022", "H022", "N1"]
    assert {p.rsplit("/", 1)[0].rsplit("=", 1)[1] for p in review.inputFiles() if "/result/bucket=" in p} == {"1", "2", "4"}
    changes = {(r.action, r.old_value, r.value) for r in store.read(CHANGES_TABLE).collect()}
    assert changes == {("updated", "12.0", "99.0"), ("unchanged", "22.0", "22.0"), ("new", None, "7.0")}


def test_counts_of_the_commit_log(spark, store):
    snapshot = store.read_model()
    for name in MODEL_TABLES:
        table = snapshot[name]
        assert snapshot.n_rows(name) == table.count()
        assert snapshot.max_id(name) == table.agg({KEYS[name].id_col: "max"}).first()[0]
    # A table without a declared schema, an empty one and one by a shuffle.
    store.publish({"notes": spark.range(7).groupBy("id").count(), "none": spark.range(0)}, run_id="notes")
    snapshot = store.read_model()
    assert snapshot.n_rows("notes") == 7 and snapshot.n_rows("none") == 0
    assert {r[0]: r[1] for r in migration_summary(snapshot).collect()} == {name: snapshot[name].count() for name in MODEL_TABLES}


def test_a_second_audit_run_writes_only_its_new_rows(spark, store):
    rows = [("X1", "Nobody", "1/6/2026", "Main", "A", "Time", str(i)) for i in range(5)]
    val, _ = submit(spark, store, rows)
    store.publish({"rejected_records": Append(val.audit_inserted)}, run_id="first")
    first = store.read_model()
    stamps = files_of(first.paths("rejected_records"))
    val, _ = submit(spark, store, rows + [("X2", "Nobody", "1/6/2026", "Main", "A", "Time", "1")])
    run = store.publish({"rejected_records": Append(val.audit_inserted)}, run_id="second")
    second = store.read_model()
    new = [p for p in second.paths("rejected_records") if p not in first.paths("rejected_records")]
    assert len(new) == 1 and run in new[0] and spark.read.parquet(new[0]).count() == 1
    assert files_of(first.paths("rejected_records")) == stamps
    assert sorted(r["rejected_id"] for r in second["rejected_records"].collect()) == [1, 2, 3, 4, 5, 6] and second.max_id("rejected_records") == 6


def test_replace_and_reset_start_a_table_anew(spark, store):
    whole = store.read("result")
    store.publish({"result": whole.where("batch_id <= 15")}, run_id="replace")
    model = store.read_model()
    assert model["result"].count() == 30 == model.n_rows("result") and model.widths == {"result": 10} and model.max_id("result") == 30
    store.initialize(reset=True)
    model = store.read_model()
    assert all(model[t].count() == 0 for t in MODEL_TABLES) and model.n_rows("result") == 0 and model.max_id("batch") == 0


def test_a_run_that_dies_leaves_no_trace(spark, store):
    before = store.read_model()
    broken = store.read("batch").selectExpr("*", "raise_error('lost') AS x").drop("batch_name").withColumnRenamed("x", "batch_name")
    with pytest.raises(Exception, match="lost"):
        store.publish({"result": Append(before["result"].limit(0)), "batch": Append(broken)}, run_id="dead")
    after = store.read_model()
    assert after.paths("batch") == before.paths("batch") and after.paths("result") == before.paths("result")


def test_history_runs_append(spark, store):
    mig = migrate_history(frame(spark, [*history(3), ("Z1", "Other", "2/2/2026", "Main", "A", "Time", "1")]), store.read_model(), run_ts=run_timestamp(spark))
    store.publish({k: Append(mig.inserted[k]) for k in MODEL_TABLES}, run_id="history")
    model = store.read_model()
    assert {t: model.n_rows(t) for t in MODEL_TABLES} == {t: model[t].count() for t in MODEL_TABLES}
    assert model.n_rows("batch") == 41 and model.n_rows("manufacturer") == 2 and model.n_rows("result") == 81
    assert sorted(r["batch_id"] for r in model["batch"].collect()) == list(range(1, 42))


def test_verify_reports_every_broken_constraint(spark, store):
    from lotgate.plans.jobs import verify_store

    assert verify_store(spark, store.root) == []
    batch, process = store.read("batch"), store.read("process")
    store.publish({"batch": Append(batch.where("batch_id = 1").selectExpr("99 AS batch_id", "batch_name", "dom", "7 AS manufacturer_id")),
                   "process": Append(process.selectExpr("5 AS process_id", "'P2' AS process_name").unionByName(
                       process.selectExpr("5 AS process_id", "'P3' AS process_name")))}, run_id="broken")
    assert sorted(verify_store(spark, store.root)) == [
        "batch: duplicate batch_name", "batch: manufacturer_id without a row in manufacturer", "process: duplicate process_id"]


def test_inserted_rows_of_every_table_are_checked(spark):
    from lotgate.operators.constraints import ConstraintViolation, check_inserted
    from lotgate.schemas import KEYS, SCHEMAS

    for name, keys in KEYS.items():
        def value(field, i):
            return {"string": f"x{i}", "bigint": i, "double": 1.0, "date": None, "timestamp": None}[field.dataType.simpleString()]
        rows = [[value(f, i) for f in SCHEMAS[name]] for i in (1, 2)]
        nullable = conform(spark.createDataFrame([], SCHEMAS[name]), name).selectExpr(*[f"nullif({f.name}, {f.name}) AS {f.name}" for f in SCHEMAS[name]]).schema
        check_inserted({name: spark.createDataFrame(rows, nullable)})
        twice = [rows[0], [rows[0][SCHEMAS[name].fieldNames().index(c)] if c in keys.business_key else x for c, x in zip(SCHEMAS[name].fieldNames(), rows[1])]]
        with pytest.raises(ConstraintViolation, match=f"{name}: duplicate"):
            check_inserted({name: spark.createDataFrame(twice, nullable)})
        for column in keys.not_null:
            missing = [[None if c == column else x for c, x in zip(SCHEMAS[name].fieldNames(), rows[0])]]
            with pytest.raises(ConstraintViolation, match=f"{name}: 1 NULL"):
                check_inserted({name: spark.createDataFrame(missing, nullable)})
