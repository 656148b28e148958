"""The jobs read what they are given once, however often they need it."""

from conftest import frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotgate.operators.audit import audit_rejections
from lotgate.operators.lookups import restrict_for_anti_join
from lotgate.plans.migrate import migrate_history
from lotgate.plans.validate import validate_uploads
from lotgate.schemas import empty_table

ROWS = [("B%d" % (i // 2), "M1", "1/%d/2026" % (i // 2 + 1), "P1", "U1", "N%d" % (i % 2), str(i)) for i in range(20)]


def _counted(df, spark):
    """*df*, and an accumulator of the rows that were taken from it."""
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text
    return df.withColumn("Batch Name", F.udf(look, T.StringType()).asNondeterministic()("Batch Name")), seen


def test_history_is_read_once(spark):
    history, seen = _counted(frame(spark, ROWS), spark)
    migrated = migrate_history(history)
    assert {n: migrated.model[n].count() for n in ("batch", "result")} == {"batch": 10, "result": 20}
    assert migrated.skipped.count() == 0
    assert seen.value == len(ROWS)


def test_submissions_are_read_once(spark):
    model = migrate_history(frame(spark, ROWS)).model
    uploads = frame(spark, [(*r, "f.csv") for r in [*ROWS, (None, *ROWS[0][1:])]], extra=["source_file"])
    uploads, seen = _counted(uploads, spark)
    validated = validate_uploads(uploads, model)
    assert (validated.valid.count(), validated.audit.count()) == (20, 1)
    assert seen.value == len(ROWS) + 1


def test_keys_of_a_small_table_are_not_sought(spark):
    """An anti join with a small (a new, empty) table does not run its other side first."""
    keys, seen = _counted(frame(spark, ROWS), spark)
    table = empty_table(spark, "batch")
    assert restrict_for_anti_join(table, "batch_name", keys, "Batch Name").count() == 0
    assert seen.value == 0


def test_audit_json_is_not_shuffled(spark, monkeypatch):
    from lotgate.operators import keys

    written, write = [], keys.materialize
    monkeypatch.setattr(keys, "materialize", lambda df, name: written.append(df.columns) or write(df, name))
    staged = frame(spark, [(*ROWS[0], "f.csv", "dom")] * 3, extra=["source_file", "rejection_stage"])
    staged = staged.withColumns({"is_rejected": F.lit(True), "load_timestamp": F.lit("2026-01-01").cast("timestamp"), "rejection_rule": F.lit("dom")})
    rows = audit_rejections(staged, empty_table(spark, "rejected_records"), F.lit("2026-01-01").cast("timestamp")).inserted
    assert [(r["rejected_id"], '"Batch Name":"B0"' in r["raw_data"], "rejection_rule" in r["raw_data"]) for r in rows.collect()] == [(1, True, False)]
    assert written and not any("raw_data" in columns for columns in written)


def test_submitted_batches_are_found_once(spark, monkeypatch):
    """Beyond the broadcast bound the names filter the batch table; the rows behind them are read once for all."""
    from lotgate.plans import load

    model = migrate_history(frame(spark, ROWS[:10])).model
    uploads = frame(spark, [(*r, "f.csv") for r in ROWS], extra=["source_file"])
    valid = validate_uploads(uploads, model).valid
    find, counts = load.new_batch_rows, []

    def counted(rows, manufacturer):
        rows, seen = _counted(rows, spark)
        counts.append(seen)
        return find(rows, manufacturer)
    monkeypatch.setattr(load, "new_batch_rows", counted)
    spark.conf.set("lotgate.broadcast.maxRows", "1")
    try:
        loaded = load.recurring_load(valid, model)
        assert (loaded.new_batches.count(), loaded.model["result"].count()) == (5, 20)
    finally:
        spark.conf.unset("lotgate.broadcast.maxRows")
    assert [c.value for c in counts] == [len(ROWS)]


def test_history_groups_where_the_orders_left_its_rows(spark, tmp_path):
    """By shuffle joins alone, the line items move by part and by order, and not for the suppliers or the groups."""
    from datetime import datetime

    from lotgate import fixtures

    tables = {
        "lineitem": (["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"], [(i // 2, i % 2, i % 2, float(i)) for i in range(12)]),
        "orders": (["o_orderkey", "o_custkey", "o_orderdate"], [(i, i, datetime(2026, 1, i + 1)) for i in range(6)]),
        "part": (["p_partkey", "p_name", "p_brand", "p_type"], [(0, "n0", "u", "p"), (1, "n1", "u", "p")]),
        "supplier": (["s_suppkey", "s_name"], [(0, "S0"), (1, "S1"), (2, "S2")]),
    }
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = fixtures.hist(spark, str(tmp_path))
        plan = history._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(l_orderkey") == 1
        rows = {(r["Batch Name"], r["Manufacturer"], r["DoM"], r["Parameter"], r["Value"]) for r in history.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert rows == {(f"O{i // 2}", f"S{i // 2 % 3}", f"1/{i // 2 + 1}/2026", f"n{i % 2}", f"{float(i)}") for i in range(12) if i // 2 % 4}


def _tables(spark, folder):
    from datetime import datetime

    tables = {
        "lineitem": (["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"], [(i // 2, i % 2, i % 2, float(i)) for i in range(12)]),
        "orders": (["o_orderkey", "o_custkey", "o_orderdate"], [(i, i, datetime(2026, 1, i + 1)) for i in range(6)]),
        "part": (["p_partkey", "p_name", "p_brand", "p_type"], [(0, "n0", "u", "p"), (1, "n1", "u", "p")]),
        "supplier": (["s_suppkey", "s_name"], [(0, "S0"), (1, "S1"), (2, "S2")]),
    }
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{folder}/{name}.parquet")


def test_rows_are_not_shuffled_to_meet_the_hierarchy(spark, tmp_path):
    from lotgate.registry import queries

    _tables(spark, tmp_path)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("anti_single", "anti_hierarchy2", "anti_hierarchy3"):
            found = queries()[name](spark, str(tmp_path))
            plan = found._jdf.queryExecution().executedPlan().toString()
            anti = next(x for x in plan.splitlines() if "LeftAnti" in x)
            assert "BroadcastHashJoin" in anti, name
            assert "hashpartitioning(Process" not in plan and "hashpartitioning(Manufacturer" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_audit_json_is_read_once_for_its_fields(spark):
    from types import SimpleNamespace

    from lotgate import registry

    rows = spark.createDataFrame([
        ("h1", '{"Batch Name":"B1","Value":null,"rejection_stage":"dom","is_rejected":true,"source_file":"f.csv"}'),
        ("h2", '{"Batch Name":"a, \\"b\\"","Value":"1.0","is_rejected":false,"more":"x","yet":{"Value":"2"}}'),
        ("h3", None), ("h3", "{}")], "rejection_hash string, raw_data string").repartition(2)
    out = registry._reject_json(SimpleNamespace(validation=SimpleNamespace(audit_inserted=rows)))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        ("h1", "B1", None, "dom", True, "f.csv", 5), ("h2", 'a, "b"', "1.0", None, False, None, 5),
        ("h3", None, None, None, None, None, None), ("h3", None, None, None, None, None, 0)], key=str)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
