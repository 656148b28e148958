"""Headline timings: history migration, validation gate, rejection audit,
recurring load and load review at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Inputs (history and upload submissions derived from the driver's tables) are
written to Parquet first and not timed, as a real intake job reads files.
Each step is forced to completion (its outputs are written or counted).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lotgate import fixtures as fx  # noqa: E402
from lotgate.operators.audit import audit_rejections  # noqa: E402
from lotgate.plans.load import recurring_load  # noqa: E402
from lotgate.plans.migrate import migrate_history  # noqa: E402
from lotgate.plans.validate import validate_uploads  # noqa: E402
from lotgate.schemas import MODEL_TABLES, empty_table  # noqa: E402
from lotgate.session import ensure_checkpoint_dir, materialize, scratch_path  # noqa: E402


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage timings, scratch folder only
    if event_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("lotgate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2 if cpus.isdigit() else 16))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Checkpoint files of frames no longer referenced are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def one_round(spark: SparkSession, hist_path: str, upload_path: str) -> dict[str, float]:
    hist = spark.read.parquet(hist_path)
    upload = spark.read.parquet(upload_path)
    times: dict[str, float] = {}

    def migrate():
        mig = migrate_history(hist, run_ts=fx.ts(fx.MIGRATION_TS))
        # Force every next-state table to exist (as a publish would).
        model = {k: materialize(mig.model[k], k) for k in MODEL_TABLES}
        return model
    model, times["history_migration"] = timed(migrate)

    def gate():
        v = validate_uploads(upload, model, run_ts=fx.ts(fx.VALIDATION_TS), persist=True)
        v.counts.collect()
        v.by_stage.collect()
        return v
    val, times["validation_gate"] = timed(gate)

    def audit():
        a = audit_rejections(val.staged, empty_table(spark, "rejected_records"), fx.ts(fx.VALIDATION_TS))
        return a.next_state.count()
    _, times["rejection_audit"] = timed(audit)

    clean = materialize(fx.clean(val.valid), "clean")

    def load():
        ld = recurring_load(clean, model)
        nxt = {k: materialize(ld.model[k], k) for k in ("batch", "result")}
        ld.classified.groupBy("action").count().collect()
        return ld, nxt
    (ld, nxt), times["recurring_load"] = timed(load)

    def review():
        m = dict(model)
        m.update(nxt)
        from lotgate.plans.load import review_loaded
        return review_loaded(m, clean).select(F.count(F.lit(1))).collect()
    _, times["load_review"] = timed(review)
    return times


def gate_exchanges(spark: SparkSession, hist_path: str, upload_path: str) -> dict[str, int]:
    """Shuffles in the rule gate's physical plan: all, and those that
    partition the submission rows by batch name (the design target is 0)."""
    import contextlib
    import io

    from lotgate.operators.rules import label_rows
    from lotgate.plans.validate import stage_raw

    model = migrate_history(spark.read.parquet(hist_path)).model
    staged = label_rows(stage_raw(spark.read.parquet(upload_path), fx.ts(fx.VALIDATION_TS)), model)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        staged.explain()
    plan = buf.getvalue()
    import re

    return {"gate_shuffles": len(re.findall(r"(?<!Broadcast)Exchange ", plan)),
            "gate_broadcasts": plan.count("BroadcastExchange "),
            "gate_row_shuffles": plan.count("hashpartitioning(Batch Name")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = session(cpus)

    hist_path = scratch_path(spark, "bench-hist")
    upload_path = scratch_path(spark, "bench-upload")
    files = int(cpus) * 2 if cpus.isdigit() else 16
    fx.hist(spark, sf_dir).repartition(files).write.parquet(hist_path)
    fx.upload(spark, sf_dir).repartition(files).write.parquet(upload_path)

    one_round(spark, hist_path, upload_path)  # warm-up
    runs = [one_round(spark, hist_path, upload_path) for _ in range(rounds)]
    queries = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    total = round(sum(queries.values()), 3)
    shuffles = gate_exchanges(spark, hist_path, upload_path)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "intake_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": queries,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "rounds": rounds,
        **shuffles,
    }))


if __name__ == "__main__":
    main()
