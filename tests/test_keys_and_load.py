"""Key assignment (K-1), history migration (M-1, D21-D23), recurring load
(L-1, D19, D24-D26), the audit (R-1, D17, D18) and publishing (U-5 to U-7, S-13)."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import frame
from lotgate.operators.constraints import ConstraintViolation, DuplicateResultsError
from lotgate.operators.keys import assign_keys
from lotgate.plans.load import recurring_load
from lotgate.plans.migrate import migrate_history
from lotgate.plans.publish import ModelStore
from lotgate.plans.validate import validate_uploads
from lotgate.session import scratch_path

HISTORY = [
    ("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "10"),
    ("B1", "Maker A", "8/1/2026", "P1", "U1", "Flow", "5"),
    ("B2", "Maker B", " 9/3/2026\t", "P1", "U2", "Mix", "7"),
]
_M = {}


def model(spark):
    if "m" not in _M:
        _M["m"] = migrate_history(frame(spark, HISTORY)).model
    return _M["m"]


def test_keys_are_rank_after_max(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(500)], "k string").orderBy(F.rand(1))
    got = assign_keys(df.repartition(13), ["k"], "id", start_after=41, num_partitions=7)
    rows = sorted((r.k, r.id) for r in got.collect())
    assert [i for _, i in rows] == list(range(42, 542))


def test_keys_composite_and_stable(spark):
    df = spark.createDataFrame([(i % 5, f"n{i}") for i in range(60)], "a long, b string")
    one = {(r.a, r.b): r.id for r in assign_keys(df, ["a", "b"], "id", num_partitions=4).collect()}
    two = {(r.a, r.b): r.id for r in assign_keys(df.repartition(9), ["a", "b"], "id", num_partitions=3).collect()}
    assert one == two
    assert sorted(one.values()) == list(range(1, 61))
    assert [one[k] for k in sorted(one)] == list(range(1, 61))


def test_key_input_is_evaluated_once_and_offsets_are_joined(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(0, 400, numPartitions=5).mapInPandas(count, "id long").select(F.col("id").alias("k"))
    got = assign_keys(rows, ["k"], "id", start_after=10, num_partitions=6)
    assert seen.value == 400
    assert sorted((r.k, r.id) for r in got.collect()) == [(i, i + 11) for i in range(400)]
    assert seen.value == 400
    plan = got._jdf.queryExecution().toString()
    assert "element_at" not in plan and "array(" not in plan
    assert assign_keys(spark.createDataFrame([], "k long"), ["k"], "id").count() == 0


def test_migration_tables(spark):
    m = model(spark)
    assert sorted((r.name, r.manufacturer_id) for r in m["manufacturer"].collect()) == [("Maker A", 1), ("Maker B", 2)]
    b2 = m["batch"].filter("batch_name = 'B2'").first()
    assert str(b2.dom) == "2026-09-03"  # history strips all whitespace (F-10)
    assert m["result"].count() == 3
    assert {r.value for r in m["result"].collect()} == {"10.0", "5.0", "7.0"}


def test_migration_rerun_adds_nothing_and_never_updates(spark):
    # D22: history keeps the stored value even when the source differs.
    changed = [r[:6] + ("99",) for r in HISTORY]
    again = migrate_history(frame(spark, changed), model(spark)).model
    assert again["result"].count() == 3
    assert "99.0" not in {r.value for r in again["result"].collect()}
    assert again["unit_operation"].count() == model(spark)["unit_operation"].count()


def test_migration_conflicting_batch_fails(spark):
    # D23: the same batch with two dates cannot be stored.
    rows = HISTORY + [("B1", "Maker A", "8/2/2026", "P1", "U1", "Mix", "1")]
    with pytest.raises(ConstraintViolation):
        migrate_history(frame(spark, rows))


def test_migration_skips_null_key_parts(spark):
    # D21 (deliberate divergence): reported, not half-inserted.
    rows = HISTORY + [("B7", "Maker A", "8/1/2026", "P1", None, "Temp", "1")]
    mig = migrate_history(frame(spark, rows))
    assert mig.skipped.count() == 1
    assert mig.model["unit_operation"].filter(F.col("unit_operation_name").isNull()).count() == 0


def upload(spark, rows, file="u.csv"):
    return frame(spark, [r + (file,) for r in rows], extra=["source_file"])


def test_load_updates_inserts_and_is_idempotent(spark):
    m = model(spark)
    rows = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "10.0"),   # unchanged (numeric)
            ("B1", "Maker A", "8/1/2026", "P1", "U1", "Flow", "6"),      # updated
            ("B4", "Maker B", "7/7/2026", "P1", "U2", "Mix", "3")]       # new batch, new result
    v = validate_uploads(upload(spark, rows), m)
    ld = recurring_load(v.valid, m)
    acts = sorted((r.batch_id, r.action) for r in ld.classified.collect())
    assert [a for _, a in acts] == ["unchanged", "updated", "new"]
    assert ld.new_batches.count() == 1
    res = {(r.batch_id, r.parameter_id): r.value for r in ld.model["result"].collect()}
    assert len(res) == 4 and "6.0" in res.values()
    # D26: the review lists every result of the touched batches.
    assert ld.review.count() == 3
    # Running the same load on the next state changes nothing.
    again = recurring_load(v.valid, ld.model)
    assert {r.action for r in again.classified.collect()} == {"unchanged"}


def test_duplicate_input_stops_load(spark):
    # D19: duplicates across files abort before any write.
    rows = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp", "1")]
    up = upload(spark, rows, "a.csv").unionByName(upload(spark, rows, "b.csv"))
    v = validate_uploads(up, model(spark))
    with pytest.raises(DuplicateResultsError) as err:
        recurring_load(v.valid, model(spark))
    assert err.value.report.first()["record_count"] == 2


def test_audit_hash_json_and_idempotence(spark):
    rows = [(None, "Maker A", "8/1/2026", "P1", "U1", "Temp", "1"),
            ("B1", "Nobody", "8/1/2026", "P1", "U1", "Temp", None)]
    m = dict(model(spark))
    v = validate_uploads(upload(spark, rows), m)
    audit = v.audit.checkpoint()
    assert audit.count() == 2
    rec = {r.rejection_stage: r for r in audit.collect()}
    raw = json.loads(rec["batch_name"].raw_data)
    # D17: the staging row with its NULL fields and the gate's columns.
    assert raw["Batch Name"] is None and raw["is_rejected"] is True and "load_timestamp" in raw
    import hashlib
    text = "|".join(["u.csv", "batch_name", "", "Maker A", "8/1/2026", "P1", "U1", "Temp", "1.0"])
    assert rec["batch_name"].rejection_hash == hashlib.md5(text.encode()).hexdigest()
    m["rejected_records"] = audit
    again = validate_uploads(upload(spark, rows), m)
    assert again.audit_inserted.count() == 0 and again.audit.count() == 2


def test_publish_dry_run_and_reset_guard(spark):
    store = ModelStore(scratch_path(spark, "store-test"), spark)
    store.initialize()
    with pytest.raises(FileExistsError):
        store.initialize()
    store.publish({k: v for k, v in model(spark).items()}, run_id="history")
    before = store.read("result").count()
    rows = [("B4", "Maker B", "7/7/2026", "P1", "U2", "Mix", "3")]
    v = validate_uploads(upload(spark, rows), store.read_model())
    ld = recurring_load(v.valid, store.read_model())  # dry run: not published
    assert ld.model["result"].count() == before + 1
    assert store.read("result").count() == before
    store.publish({"batch": ld.model["batch"], "result": ld.model["result"]}, run_id="load")
    assert store.read("result").count() == before + 1
    assert store.read("manufacturer").count() == 2
    store.initialize(reset=True)
    assert store.read("result").count() == 0


def test_keys_with_adaptive_partitions(spark):
    # Default path: AQE sizes (and may merge) the range partitions.
    df = spark.createDataFrame([(i % 7, f"n{i:03d}") for i in range(300)], "a long, b string")
    got = assign_keys(df.repartition(11), ["a", "b"], "id", start_after=5)
    ids = {(r.a, r.b): r.id for r in got.collect()}
    assert [ids[k] for k in sorted(ids)] == list(range(6, 306))


def test_load_without_broadcast_matches(spark):
    # Beyond the broadcast bound every join falls back to a shuffle join;
    # the result must not change.
    m = model(spark)
    rows = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Flow", "6"),
            ("B4", "Maker B", "7/7/2026", "P1", "U2", "Mix", "3")]
    v = validate_uploads(upload(spark, rows), m, persist=False)
    fast = sorted((r.batch_id, r.parameter_id, r.value) for r in recurring_load(v.valid, m).model["result"].collect())
    spark.conf.set("lotgate.broadcast.maxRows", "0")
    try:
        v2 = validate_uploads(upload(spark, rows), m, persist=False)
        slow = sorted((r.batch_id, r.parameter_id, r.value) for r in recurring_load(v2.valid, m).model["result"].collect())
        stages = sorted(r.rejection_stage or "" for r in v2.staged.collect())
    finally:
        spark.conf.unset("lotgate.broadcast.maxRows")
    assert fast == slow
    assert stages == ["", ""]


def test_hot_batch_on_shuffle_path_with_skew_splits(spark):
    # One batch holds a third of the upload.  With the broadcast bound at 0
    # every join is a shuffle join; AQE thresholds are lowered so the hot
    # partition is split.  Labels and loaded results must not change.
    m = model(spark)
    hot = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Temp" if i % 2 else "Flow", str(i)) for i in range(60)]
    cold = [(f"C{i}", "Maker B", "9/9/2026", "P1", "U2", "Mix", "1") for i in range(120)]
    rows = hot + cold

    def run():
        up = upload(spark, rows).repartition(6)
        v = validate_uploads(up, m, persist=False)
        labels = sorted((r["Batch Name"], r["Value"], r.rejection_stage or "") for r in v.staged.collect())
        return labels, v

    fast, _ = run()
    conf = {"lotgate.broadcast.maxRows": "0",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        slow, v = run()
        # B1's rows disagree on Value only, so they pass; duplicates stop the load.
        with pytest.raises(DuplicateResultsError):
            recurring_load(v.valid, m)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert fast == slow
    assert sum(1 for b, _, s in slow if b == "B1" and s == "") == 60


def test_timestamps_follow_validation_and_updates_touch_value_only(spark):
    # D24: new rows take the validation time; D25: an update changes only
    # value and modified_at (created_at and the id stay).
    m = model(spark)
    before = {(r.batch_id, r.parameter_id): r for r in m["result"].collect()}
    rows = [("B1", "Maker A", "8/1/2026", "P1", "U1", "Flow", "6"),
            ("B5", "Maker B", "5/5/2026", "P1", "U2", "Mix", "2")]
    ts = F.to_timestamp(F.lit("2030-01-02 03:04:05"))
    v = validate_uploads(upload(spark, rows), m, run_ts=ts)
    ld = recurring_load(v.valid, m)
    after = {(r.batch_id, r.parameter_id): r for r in ld.model["result"].collect()}
    stamp = "2030-01-02 03:04:05"
    changed = [k for k in before if after[k].value != before[k].value]
    assert len(changed) == 1
    k = changed[0]
    assert after[k].result_id == before[k].result_id
    assert after[k].created_at == before[k].created_at
    assert str(after[k].modified_at) == stamp
    new = [r for key, r in after.items() if key not in before]
    assert len(new) == 1 and str(new[0].created_at) == stamp == str(new[0].modified_at)
    b5 = ld.model["batch"].filter("batch_name = 'B5'").first()
    assert str(b5.created_at) == stamp


def test_all_digit_names_and_blank_columns_do_not_abort(spark):
    # D27: text is read as text, so numeric-looking names are ordinary names.
    hist = [("1001", "7", "1/1/2026", "10", "20", "30", "1")]
    m = migrate_history(frame(spark, hist)).model
    rows = [("1001", "7", "1/1/2026", "10", "20", "30", "2"),
            ("1002", "7", "1/1/2026", "10", "20", "30", None)]
    v = validate_uploads(upload(spark, rows), m)
    assert [r.rejection_stage for r in v.staged.orderBy("Batch Name").collect()] == [None, None]
    ld = recurring_load(v.valid, m)
    assert sorted(r.action for r in ld.classified.collect()) == ["new", "updated"]


def test_keys_beyond_the_bound_filter_by_a_bloom_filter(spark):
    from lotgate.operators.lookups import bloom_restrict, restrict_to_keys

    table = spark.range(50_000).selectExpr("concat('k', id) AS k", "id AS n").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    keys = spark.range(0, 50_000, 7).selectExpr("concat('k', id) AS h").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    passed = bloom_restrict(table, "k", keys, "h")
    assert passed.columns == table.columns
    names = {r["k"] for r in passed.collect()}
    wanted = {f"k{i}" for i in range(0, 50_000, 7)}
    assert wanted <= names and len(names) < len(wanted) * 1.05  # every key, few others
    exact = restrict_to_keys(table, "k", keys, "h", small=False)
    assert {r["k"] for r in exact.collect()} == wanted == {r["k"] for r in restrict_to_keys(table, "k", keys, "h", small=True).collect()}
    empty = restrict_to_keys(table, "k", keys.limit(0), "h", small=False)
    assert empty.count() == 0


def test_conflicts_of_an_upload_use_a_hash_aggregate(spark):
    from lotgate.operators.rules import upload_conflicts

    rows = frame(spark, [("A", "M", "1/1/2026", "P", "U", "T", "1"), ("A", " M ", "1/1/2026 ", "P", "U", "T", "2"), ("B", "M", "1/1/2026", "P", "U", "T", "1"),
                         ("B", "N", "1/1/2026", "P", "U", "T", "1"), ("C", None, "1/1/2026", "P", "U", "T", "1"), ("C", "M", "1/1/2026", "P", "U", "T", "1"),
                         ("D", None, "1/1/2026", "P", "U", "T", "1"), ("E", "M", "1/2/2026", "P", "U", "T", "1"), ("E", "M", "1/1/2026", "P", "U", "T", "1")])
    found = upload_conflicts(rows)
    assert {r["Batch Name"]: r["_conflict"] for r in found.collect()} == {"A": False, "B": True, "C": False, "D": False, "E": True}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_hot_and_missing_names_spread_over_the_shuffle(spark):
    """A third of the rows in one batch, a third without a name, no broadcast of
    the table, no help by AQE: no task holds more than three times the median."""
    from lotgate.operators.lookups import heavy_names, spread_join

    rows = spark.range(12_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN CASE id % 2 WHEN 0 THEN '  ' END ELSE concat('b', id % 3000) END AS name", "id AS `Row No`")
    table = spark.range(3000).selectExpr("concat('b', id) AS key", "id AS v").union(spark.sql("SELECT 'hot', CAST(-1 AS BIGINT)"))
    assert heavy_names(rows, "name") == ["  ", "hot"]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = spread_join(rows, "name", table, "key")
        found = joined.withColumn("task", F.spark_partition_id()).collect()
        inner = spread_join(rows, "name", table, "key", inner=True).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert joined.columns == ["name", "Row No", "v"] and len(found) == 12_000 and inner == 8_000
    for r in found:
        assert r["v"] == (-1 if r["name"] == "hot" else int(r["name"][1:]) if (r["name"] or "").startswith("b") else None)
    sizes = sorted(sum(r["task"] == t for r in found) for t in {r["task"] for r in found})
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    none = spread_join(rows.limit(0), "name", table, "key")
    assert none.count() == 0


def test_reports_are_sorted(spark):
    """The place of each row in the duplicate report and the summary by stage (O-1, O-2)."""
    from lotgate.operators.audit import rejections_by_stage
    from lotgate.operators.constraints import duplicate_results

    names = [(f"B{i % 7}", f"P{i % 3}", f"U{i % 2}", f"T{i % 5}") for i in range(420)]
    valid = spark.createDataFrame(names, ["Batch Name", "Process", "Unit Operation", "Parameter"]).repartition(5)
    report = [tuple(r)[:4] for r in duplicate_results(valid).collect()]
    assert report == sorted(set(names)) and len(report) > 100
    staged = spark.createDataFrame([(i % 4 > 0, f"stage {i % 9}") for i in range(300)], "is_rejected boolean, rejection_stage string").repartition(5)
    stages = [r["rejection_stage"] for r in rejections_by_stage(staged).collect()]
    assert stages == sorted(stages) and len(stages) == 9
