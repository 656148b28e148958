"""Checks for the correctness gate: ``queries()`` and their ``oracle_sql()`` twins.

Every check runs the library over frames derived from the driver's tables
(``lotgate.fixtures``) and returns a DataFrame; the twin states the same
result in DuckDB SQL (``lotgate.oracle``).  Timestamps are left out of the
compared columns and dates are compared as ISO text.

The stored state a check needs (migrated model, validated upload, loaded
model) is built once per session and data folder and reused; every piece is
derived by Spark from the tables and held in the reliable checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotgate import fixtures as fx
from lotgate.functions.audit import HASH_FIELDS, rejection_hash
from lotgate.functions.dates import parse_dom
from lotgate.functions.numbers import canonical_value
from lotgate.operators.constraints import dangling_references, duplicate_keys, duplicate_results, null_counts
from lotgate.operators.keys import assign_keys
from lotgate.operators.lookups import (
    bounded_broadcast, hierarchy_dim, lookup_manufacturer, lookup_unit_operation, resolve_keys, unit_operation_dim,
)
from lotgate.operators.audit import audit_rejections
from lotgate.operators.rules import rule_hits, upload_conflicts, survivors_of_row_rules
from lotgate.oracle import NUM_RE, with_ctes
from lotgate.plans.load import recurring_load
from lotgate.plans.migrate import distinct_entities, entity_rows, migrate_history, migration_summary
from lotgate.plans.publish import ModelStore
from lotgate.plans.validate import stage_raw, validate_uploads
from lotgate.schemas import REQUIRED_COLUMNS
from lotgate.session import ensure_checkpoint_dir, materialize, scratch_path
from lotgate.sources.uploads import discover_uploads, file_name, read_history, read_uploads
from lotgate.streaming.intake import start_intake

SUBMISSION = REQUIRED_COLUMNS + ["source_file"]
STAGED_OUT = SUBMISSION + ["is_rejected", "rejection_stage"]


def _iso(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def _note():
    """A text with a delimiter, quotes and a line end, to be carried by CSV files."""
    return F.concat(F.col("Parameter"), F.lit(', "'), F.col("Process"), F.lit('"\n'), F.coalesce("Value", F.lit(""))).alias("Note")


def _write_csv(rows: DataFrame, folder: str) -> None:
    (rows.write.mode("append").option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder))


class State:
    """Lazily built, memoised state of one (session, data folder)."""

    _cache: dict[tuple[str, str], "State"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        ensure_checkpoint_dir(spark)
        self._memo: dict[str, object] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "State":
        try:
            app = spark.sparkContext.applicationId
        except Exception:  # a client session has no context; key by session
            app = str(id(spark))
        key = (app, os.path.abspath(sf_dir))
        if key not in cls._cache:
            cls._cache[key] = cls(spark, sf_dir)
        return cls._cache[key]

    def _get(self, name: str, build: Callable[[], object]):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def hist(self) -> DataFrame:
        return self._get("hist", lambda: fx.hist(self.spark, self.sf_dir))

    @property
    def upload(self) -> DataFrame:
        return self._get("upload", lambda: fx.upload(self.spark, self.sf_dir))

    @property
    def migration(self):
        return self._get("migration", lambda: migrate_history(self.hist, run_ts=fx.ts(fx.MIGRATION_TS)))

    @property
    def model(self) -> dict[str, DataFrame]:
        return self.migration.model

    @property
    def hier(self) -> DataFrame:
        m = self.model
        return hierarchy_dim(m["process"], m["unit_operation"], m["parameter"])

    @property
    def validation(self):
        return self._get("validation", lambda: validate_uploads(
            self.upload, self.model, run_ts=fx.ts(fx.VALIDATION_TS)))

    @property
    def staged(self) -> DataFrame:
        return self.validation.staged

    @property
    def valid(self) -> DataFrame:
        return self.validation.valid

    @property
    def clean(self) -> DataFrame:
        return self._get("clean", lambda: materialize(fx.clean(self.valid), "clean"))

    @property
    def load(self):
        return self._get("load", lambda: recurring_load(self.clean, self.model))

    @property
    def csv_folder(self) -> str:
        return self._get("csv_folder", self._write_uploads)

    def _write_uploads(self) -> str:
        """Write the upload as CSV files whose headers order columns differently."""
        folder = scratch_path(self.spark, "uploads")
        up = materialize(self.upload, "submitted").withColumn("Submission", F.col("source_file")).drop("source_file").withColumn("Note", _note())
        orders = {
            "part_0.csv": ["Batch Name", "Process", "Manufacturer", "DoM", "Unit Operation",
                           "Parameter", "Value", "Submission", "Note"],
            "part_1.csv": ["Note"] + list(reversed(REQUIRED_COLUMNS)) + ["Submission"],
            "part_2.csv": ["Value", "Comment", "Parameter", "Unit Operation", "Process", "DoM",
                           "Manufacturer", "Note", "Batch Name", "Submission"],
        }
        for name, cols in orders.items():
            part = up.filter(F.col("Submission") == name).withColumn(
                "Comment", F.concat(F.lit("from "), F.col("Submission")))
            _write_csv(part.select(*cols), folder)
        return folder

    @property
    def history_csv(self) -> str:
        def build():
            path = scratch_path(self.spark, "history")
            _write_csv(self.hist.withColumn("Note", _note()), path)
            return path
        return self._get("history_csv", build)


# ---------------------------------------------------------------- checks ---

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None):
    def deco(fn):
        Q[name] = lambda spark, sf_dir: fn(State.of(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


_SUB_SQL = '"Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter", "Value", source_file'


_NOTE_SQL = """"Parameter" || ', "' || "Process" || '"' || chr(10) || coalesce("Value", '') AS "Note\""""


# Sources and sinks ---------------------------------------------------------

@check("scan_flat", with_ctes(
    f'SELECT "Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter", "Value", {_NOTE_SQL} FROM hist',
    upto="hist"))
def _scan_flat(st: State) -> DataFrame:
    return read_history(st.spark, st.history_csv).select(*REQUIRED_COLUMNS, "Note")


@check("scan_uploads", with_ctes(
    f"""SELECT {_SUB_SQL.replace(', source_file', '')}, {_NOTE_SQL}, source_file AS submitted_file,
              TRUE AS file_is_listed, CAST(1 AS BIGINT) AS submissions_of_file FROM upload""",
    upto="upload"))
def _scan_uploads(st: State) -> DataFrame:
    listed = [file_name(p) for p in discover_uploads(st.spark, st.csv_folder)]
    df = read_uploads(st.spark, st.csv_folder)
    # Each file was written from one submission.
    of_file = df.groupBy(F.col("source_file").alias("_file")).agg(F.count_distinct("Submission").alias("submissions_of_file"))
    return df.join(of_file, F.col("source_file") == F.col("_file")).select(
        *REQUIRED_COLUMNS, "Note", F.col("Submission").alias("submitted_file"),
        F.col("source_file").isin(listed).alias("file_is_listed"), "submissions_of_file")


@check("union_by_name", with_ctes(
    """SELECT "Batch Name", "Value", source_file AS submitted_file,
              CASE WHEN source_file = 'part_2.csv' THEN 'from part_2.csv' END AS "Comment"
       FROM upload""", upto="upload"))
def _union_by_name(st: State) -> DataFrame:
    df = read_uploads(st.spark, st.csv_folder)
    return df.select("Batch Name", "Value", F.col("Submission").alias("submitted_file"), "Comment")


@check("stage_raw", with_ctes(
    f"SELECT {_SUB_SQL}, FALSE AS is_rejected, CAST(NULL AS VARCHAR) AS rejection_stage FROM upload",
    upto="upload"))
def _stage_raw(st: State) -> DataFrame:
    return stage_raw(st.upload, fx.ts(fx.VALIDATION_TS)).select(*STAGED_OUT)


@check("stage_valid", with_ctes(f"SELECT {_SUB_SQL}, FALSE AS is_rejected, rejection_stage FROM valid",
                                upto="stage"))
def _stage_valid(st: State) -> DataFrame:
    return st.valid.select(*STAGED_OUT)


def _hash_sql(first: str = "source_file") -> str:
    """The rejection hash in SQL; *first* replaces the source_file field."""
    parts = [first] + [f'"{f}"' if f[0].isupper() else f for f in HASH_FIELDS[1:]]
    return "md5(" + " || '|' || ".join(f"COALESCE(CAST({p} AS VARCHAR), '')" for p in parts) + ")"


_HASH_SQL = _hash_sql()


@check("reject_json", with_ctes(
    f"""SELECT DISTINCT {_HASH_SQL} AS rejection_hash, "Batch Name" AS json_batch_name,
              "Value" AS json_value, rejection_stage AS json_stage, TRUE AS json_is_rejected,
              source_file AS json_source_file, 11 AS json_keys
       FROM rejected""", upto="stage"))
def _reject_json(st: State) -> DataFrame:
    schema = ("`Batch Name` string, `Value` string, rejection_stage string, "
              "is_rejected boolean, source_file string")
    # Read once a row: as one expression per field, each field would read the text anew.
    a = st.validation.audit_inserted.withColumn("_row", F.from_json("raw_data", schema))
    j = F.col("_row")
    return a.select(
        "rejection_hash",
        j["Batch Name"].alias("json_batch_name"), j["Value"].alias("json_value"),
        j["rejection_stage"].alias("json_stage"), j["is_rejected"].alias("json_is_rejected"),
        j["source_file"].alias("json_source_file"),
        F.size(F.json_object_keys("raw_data")).alias("json_keys"),
    )


# Projections, distinct -----------------------------------------------------

@check("distinct_names", with_ctes('SELECT DISTINCT "Manufacturer" AS name FROM flat', upto="flat"))
def _distinct_names(st: State) -> DataFrame:
    return entity_rows(distinct_entities(fx.flat(st.spark, st.sf_dir)), "manufacturer").select(F.col("Manufacturer").alias("name"))


@check("distinct_pairs", with_ctes('SELECT DISTINCT "Process", "Unit Operation" FROM flat', upto="flat"))
def _distinct_pairs(st: State) -> DataFrame:
    return entity_rows(distinct_entities(fx.flat(st.spark, st.sf_dir)), "unit_operation")


@check("distinct_triples", with_ctes(
    'SELECT DISTINCT "Process", "Unit Operation", "Parameter" FROM flat', upto="flat"))
def _distinct_triples(st: State) -> DataFrame:
    return entity_rows(distinct_entities(fx.flat(st.spark, st.sf_dir)), "parameter")


# Rules ---------------------------------------------------------------------

def _rule_sql(stage: str, scope: str | None = None) -> str:
    cond = f"rejection_stage = '{stage}'" + (f" AND metadata_scope = '{scope}'" if scope else "")
    return with_ctes(f"SELECT {_SUB_SQL} FROM staged WHERE {cond}", upto="stage")


for _rid, _stage, _scope in [
    ("batch_name", "batch_name", None), ("dom", "dom", None),
    ("upload_metadata", "batch_metadata", "upload"), ("existing_metadata", "batch_metadata", "stored"),
    ("manufacturer", "manufacturer", None), ("process", "process", None),
    ("unit_operation", "unit_operation", None), ("parameter", "parameter", None),
]:
    def _make(rule_id: str):
        internal = "stored_metadata" if rule_id == "existing_metadata" else rule_id
        return lambda st: rule_hits(st.staged, internal).select(*SUBMISSION)
    check(f"rule_{_rid}", _rule_sql(_stage, _scope))(_make(_rid))


@check("validate_stages", with_ctes(f"SELECT {_SUB_SQL}, rejection_stage IS NOT NULL AS is_rejected, "
                                    "rejection_stage FROM staged", upto="stage"))
def _validate_stages(st: State) -> DataFrame:
    return st.staged.select(*STAGED_OUT)


@check("metadata_conflicts", with_ctes(
    """SELECT "Batch Name" FROM dated WHERE NOT nameless AND day IS NOT NULL GROUP BY "Batch Name"
       HAVING count(DISTINCT trim("DoM")) > 1 OR count(DISTINCT trim("Manufacturer")) > 1""",
    upto="stage"))
def _metadata_conflicts(st: State) -> DataFrame:
    surv = st.upload.filter(survivors_of_row_rules(st.upload))
    return upload_conflicts(surv).filter("_conflict").select("Batch Name")


@check("null_safe_diff", with_ctes(
    """SELECT u."Batch Name", u."DoM", u.source_file,
              b.dom IS DISTINCT FROM CAST(try_strptime(trim(u."DoM"), '%m/%d/%Y') AS DATE) AS dom_differs
       FROM upload u JOIN m_batch b ON b.batch_name = u."Batch Name" """, upto="model"))
def _null_safe_diff(st: State) -> DataFrame:
    b = st.model["batch"].select(F.col("batch_name").alias("_bn"), F.col("dom").alias("_bd"))
    u = st.upload
    return u.join(b, u["Batch Name"] == b["_bn"]).select(
        "Batch Name", "DoM", "source_file",
        (~F.col("_bd").eqNullSafe(parse_dom(F.col("DoM")))).alias("dom_differs"))


# Joins ---------------------------------------------------------------------

@check("lookup_manufacturer", with_ctes(
    """SELECT DISTINCT h."Batch Name", m.manufacturer_id FROM hist h
       JOIN m_manufacturer m ON h."Manufacturer" = m.name""", upto="model"))
def _lookup_manufacturer(st: State) -> DataFrame:
    rows = st.hist.select("Batch Name", "Manufacturer").distinct()
    return lookup_manufacturer(rows, st.model["manufacturer"]).select("Batch Name", "manufacturer_id")


@check("lookup_unit_operation", with_ctes(
    """SELECT x."Process", x."Unit Operation", p.process_id, u.unit_operation_id
       FROM (SELECT DISTINCT "Process", "Unit Operation" FROM upload) x
       JOIN m_process p ON x."Process" = p.process_name
       JOIN m_unit_operation u ON u.process_id = p.process_id AND u.unit_operation_name = x."Unit Operation" """,
    upto="model"))
def _lookup_unit_operation(st: State) -> DataFrame:
    rows = st.upload.select("Process", "Unit Operation").distinct()
    return lookup_unit_operation(rows, st.model["process"], st.model["unit_operation"]).select(
        "Process", "Unit Operation", "process_id", "unit_operation_id")


@check("resolve_keys", with_ctes(
    """SELECT v."Batch Name", v."Process", v."Unit Operation", v."Parameter", b.batch_id, h.parameter_id
       FROM valid v JOIN m_batch b ON v."Batch Name" = b.batch_name
       JOIN m_hier h ON v."Process" = h.process_name AND v."Unit Operation" = h.unit_operation_name
                    AND v."Parameter" = h.parameter_name""", upto="stage"))
def _resolve_keys(st: State) -> DataFrame:
    return resolve_keys(st.valid, st.model["batch"], st.hier).select(
        "Batch Name", "Process", "Unit Operation", "Parameter", "batch_id", "parameter_id")


@check("denormalize", with_ctes(
    """SELECT b.batch_name, m.name AS manufacturer, h.process_name AS process,
              h.unit_operation_name AS unit_operation, h.parameter_name AS parameter, r.value
       FROM m_result r JOIN m_batch b ON r.batch_id = b.batch_id
       JOIN m_manufacturer m ON b.manufacturer_id = m.manufacturer_id
       JOIN m_hier h ON r.parameter_id = h.parameter_id""", upto="model"))
def _denormalize(st: State) -> DataFrame:
    m = st.model
    return (
        m["result"].join(m["batch"].select("batch_id", "batch_name", "manufacturer_id"), "batch_id")
        .join(m["manufacturer"].select("manufacturer_id", F.col("name").alias("manufacturer")),
              "manufacturer_id")
        .join(st.hier, "parameter_id")
        .select("batch_name", "manufacturer", F.col("process_name").alias("process"),
                F.col("unit_operation_name").alias("unit_operation"),
                F.col("parameter_name").alias("parameter"), "value")
    )


@check("anti_single", with_ctes(
    f"""SELECT {_SUB_SQL} FROM upload s
        WHERE NOT EXISTS (SELECT 1 FROM m_manufacturer m WHERE m.name = s."Manufacturer")""",
    upto="model"))
def _anti_single(st: State) -> DataFrame:
    m = bounded_broadcast(st.model["manufacturer"].select(F.col("name").alias("_n")))
    u = st.upload
    return u.join(m, u["Manufacturer"] == m["_n"], "left_anti").select(*SUBMISSION)


@check("anti_composite", with_ctes(
    """SELECT p.process_id, x."Unit Operation" AS unit_operation_name
       FROM (SELECT DISTINCT "Process", "Unit Operation" FROM upload) x
       JOIN m_process p ON x."Process" = p.process_name
       WHERE NOT EXISTS (SELECT 1 FROM m_unit_operation u
                         WHERE u.process_id = p.process_id AND u.unit_operation_name = x."Unit Operation")""",
    upto="model"))
def _anti_composite(st: State) -> DataFrame:
    m = st.model
    x = st.upload.select("Process", "Unit Operation").distinct()
    p = m["process"].select(F.col("process_name").alias("_pn"), "process_id")
    cand = x.join(p, x["Process"] == p["_pn"]).select(
        "process_id", F.col("Unit Operation").alias("unit_operation_name"))
    return cand.join(m["unit_operation"].select("process_id", "unit_operation_name"),
                     ["process_id", "unit_operation_name"], "left_anti")


@check("anti_hierarchy2", with_ctes(
    f"""SELECT {_SUB_SQL} FROM upload s WHERE NOT EXISTS (
          SELECT 1 FROM m_process p JOIN m_unit_operation u ON p.process_id = u.process_id
          WHERE p.process_name = s."Process" AND u.unit_operation_name = s."Unit Operation")""",
    upto="model"))
def _anti_hierarchy2(st: State) -> DataFrame:
    d = bounded_broadcast(unit_operation_dim(st.model["process"], st.model["unit_operation"]).select(
        F.col("process_name").alias("_p"), F.col("unit_operation_name").alias("_u")))
    u = st.upload
    return u.join(d, (u["Process"] == d["_p"]) & (u["Unit Operation"] == d["_u"]), "left_anti") \
        .select(*SUBMISSION)


@check("anti_hierarchy3", with_ctes(
    f"""SELECT {_SUB_SQL} FROM upload s WHERE NOT EXISTS (
          SELECT 1 FROM m_hier h WHERE h.process_name = s."Process"
            AND h.unit_operation_name = s."Unit Operation" AND h.parameter_name = s."Parameter")""",
    upto="model"))
def _anti_hierarchy3(st: State) -> DataFrame:
    h = bounded_broadcast(st.hier.select(
        F.col("process_name").alias("_p"), F.col("unit_operation_name").alias("_u"), F.col("parameter_name").alias("_n")))
    u = st.upload
    cond = (u["Process"] == h["_p"]) & (u["Unit Operation"] == h["_u"]) & (u["Parameter"] == h["_n"])
    return u.join(h, cond, "left_anti").select(*SUBMISSION)


@check("hierarchy_dim", with_ctes("SELECT * FROM m_hier", upto="model"))
def _hierarchy_dim(st: State) -> DataFrame:
    return st.hier


# Aggregations and summaries -------------------------------------------------

@check("validation_counts", with_ctes(
    """SELECT count(*) AS total_records, count(*) FILTER (WHERE rejection_stage IS NOT NULL) AS rejected_records,
              count(*) FILTER (WHERE rejection_stage IS NULL) AS valid_records FROM staged""", upto="stage"))
def _validation_counts(st: State) -> DataFrame:
    return st.validation.counts


@check("rejections_by_stage", with_ctes(
    """SELECT rejection_stage, count(*) AS rejected_count FROM rejected
       GROUP BY rejection_stage ORDER BY rejection_stage""", upto="stage"))
def _rejections_by_stage(st: State) -> DataFrame:
    return st.validation.by_stage


@check("duplicate_results", with_ctes(
    """SELECT "Batch Name", "Process", "Unit Operation", "Parameter", count(*) AS record_count
       FROM valid GROUP BY "Batch Name", "Process", "Unit Operation", "Parameter"
       HAVING count(*) > 1 ORDER BY 1, 2, 3, 4""", upto="stage"))
def _duplicate_results(st: State) -> DataFrame:
    return duplicate_results(st.valid)


@check("migration_summary", with_ctes(
    """SELECT 'manufacturer' AS table_name, count(*) AS row_count FROM m_manufacturer
       UNION ALL SELECT 'process', count(*) FROM m_process
       UNION ALL SELECT 'unit_operation', count(*) FROM m_unit_operation
       UNION ALL SELECT 'parameter', count(*) FROM m_parameter
       UNION ALL SELECT 'batch', count(*) FROM m_batch
       UNION ALL SELECT 'result', count(*) FROM m_result""", upto="model"))
def _migration_summary(st: State) -> DataFrame:
    return migration_summary(st.model)


# Functions -----------------------------------------------------------------

@check("parse_dom", with_ctes(
    """SELECT DISTINCT "DoM", strftime(CAST(try_strptime(trim("DoM"), '%m/%d/%Y') AS DATE), '%Y-%m-%d') AS parsed_dom
       FROM upload""", upto="upload"))
def _parse_dom(st: State) -> DataFrame:
    return st.upload.select("DoM").distinct().select(
        "DoM", F.date_format(parse_dom(F.col("DoM")), "yyyy-MM-dd").alias("parsed_dom"))


@check("rejection_hash", with_ctes(
    f"SELECT {_SUB_SQL}, rejection_stage, {_HASH_SQL} AS rejection_hash FROM rejected", upto="stage"))
def _rejection_hash(st: State) -> DataFrame:
    rej = st.staged.filter("is_rejected")
    return rej.select(*SUBMISSION, "rejection_stage", rejection_hash().alias("rejection_hash"))


# Number texts built from integer columns so both engines see the same input.
_VALUE_TEXT_SQL = """
CASE l_linenumber % 5
  WHEN 0 THEN CAST(l_partkey * 1000 + l_orderkey % 1000 AS VARCHAR) || 'e' || CAST((l_orderkey % 41) - 20 AS VARCHAR)
  WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '.' || CAST(l_orderkey % 100 AS VARCHAR)
  WHEN 2 THEN '9007199254' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') || CAST(l_orderkey % 1000 AS VARCHAR)
  WHEN 3 THEN '00' || CAST(l_partkey AS VARCHAR)
  ELSE 'lot ' || CAST(l_partkey AS VARCHAR)
END"""


@check("canonical_value", f"""
SELECT DISTINCT value_text,
  CASE WHEN regexp_matches(value_text, '^0[0-9]+$') THEN value_text
       -- Integers with more significant digits than every double keeps.
       WHEN regexp_full_match(value_text, '[0-9]+') AND length(rtrim(value_text, '0')) > 15 THEN value_text
       WHEN regexp_full_match(value_text, '{NUM_RE}') THEN spelled
       ELSE value_text END AS canonical
FROM (SELECT *, CAST(TRY_CAST(value_text AS DOUBLE) AS VARCHAR) AS spelled
      FROM (SELECT {_VALUE_TEXT_SQL} AS value_text FROM lineitem))""")
def _canonical_value(st: State) -> DataFrame:
    li = fx.table(st.spark, st.sf_dir, "lineitem")
    ln, pk, ok = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_orderkey")
    text = (
        F.when(ln % 5 == 0, F.concat((pk * 1000 + ok % 1000).cast("string"), F.lit("e"),
                                     ((ok % 41) - 20).cast("string")))
        .when(ln % 5 == 1, F.concat(pk.cast("string"), F.lit("."), (ok % 100).cast("string")))
        .when(ln % 5 == 2, F.concat(F.lit("9007199254"), F.lpad(pk.cast("string"), 6, "0"), (ok % 1000).cast("string")))
        .when(ln % 5 == 3, F.concat(F.lit("00"), pk.cast("string")))
        .otherwise(F.concat(F.lit("lot "), pk.cast("string")))
    )
    return li.select(text.alias("value_text")).distinct().select(
        "value_text", canonical_value(F.col("value_text")).alias("canonical"))


@check("assign_keys", """
SELECT batch_name, 1000 + row_number() OVER (ORDER BY batch_name) AS batch_id
FROM (SELECT DISTINCT 'O' || CAST(o_orderkey AS VARCHAR) AS batch_name FROM orders)""")
def _assign_keys(st: State) -> DataFrame:
    o = fx.table(st.spark, st.sf_dir, "orders")
    names = o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("batch_name")).distinct()
    return assign_keys(names, ["batch_name"], "batch_id", start_after=1000)


# Model tables (M-1, U-1) -----------------------------------------------------

@check("dim_manufacturer", with_ctes("SELECT manufacturer_id, name FROM m_manufacturer", upto="model"))
def _dim_manufacturer(st: State) -> DataFrame:
    return st.model["manufacturer"].select("manufacturer_id", "name")


@check("dim_process", with_ctes("SELECT process_id, process_name FROM m_process", upto="model"))
def _dim_process(st: State) -> DataFrame:
    return st.model["process"].select("process_id", "process_name")


@check("dim_unit_operation", with_ctes(
    "SELECT unit_operation_id, process_id, unit_operation_name FROM m_unit_operation", upto="model"))
def _dim_unit_operation(st: State) -> DataFrame:
    return st.model["unit_operation"].select("unit_operation_id", "process_id", "unit_operation_name")


@check("dim_parameter", with_ctes(
    "SELECT parameter_id, unit_operation_id, parameter_name FROM m_parameter", upto="model"))
def _dim_parameter(st: State) -> DataFrame:
    return st.model["parameter"].select("parameter_id", "unit_operation_id", "parameter_name")


@check("dim_batch", with_ctes(
    "SELECT batch_id, batch_name, strftime(dom, '%Y-%m-%d') AS dom, manufacturer_id FROM m_batch",
    upto="model"))
def _dim_batch(st: State) -> DataFrame:
    return st.model["batch"].select("batch_id", "batch_name", _iso("dom"), "manufacturer_id")


@check("fact_result", with_ctes("SELECT result_id, batch_id, parameter_id, value FROM m_result",
                                upto="model"))
def _fact_result(st: State) -> DataFrame:
    return st.model["result"].select("result_id", "batch_id", "parameter_id", "value")


# Load (L-1 to L-3, U-1 to U-3, U-7) -------------------------------------------

@check("new_batches", with_ctes(
    "SELECT batch_id, batch_name, strftime(dom, '%Y-%m-%d') AS dom, manufacturer_id FROM new_batch"))
def _new_batches(st: State) -> DataFrame:
    return st.load.new_batches.select("batch_id", "batch_name", _iso("dom"), "manufacturer_id")


@check("upsert_results", with_ctes(
    "SELECT batch_id, parameter_id, value, old_value, coalesce(result_id, 0) AS result_id, action FROM classified"))
def _upsert_results(st: State) -> DataFrame:
    return st.load.classified.select("batch_id", "parameter_id", "value", "old_value",
                                     F.coalesce("result_id", F.lit(0)).alias("result_id"), "action")


@check("load_updates", with_ctes(
    "SELECT batch_id, parameter_id, old_value, value FROM classified WHERE action = 'updated'"))
def _load_updates(st: State) -> DataFrame:
    return st.load.classified.filter(F.col("action") == "updated").select(
        "batch_id", "parameter_id", "old_value", "value")


@check("new_results", with_ctes(
    """SELECT result_id, batch_id, parameter_id, value FROM result_next
       WHERE result_id > (SELECT max(result_id) FROM m_result)"""))
def _new_results(st: State) -> DataFrame:
    m0 = st.model["result"].agg(F.max("result_id")).first()[0]
    return st.load.model["result"].filter(F.col("result_id") > F.lit(m0)).select(
        "result_id", "batch_id", "parameter_id", "value")


@check("load_summary", with_ctes(
    """SELECT (SELECT count(*) FROM batch_next) AS total_batches,
              (SELECT count(*) FROM result_next) AS total_results"""))
def _load_summary(st: State) -> DataFrame:
    return st.load.summary


@check("review_loaded", with_ctes(
    """SELECT b.batch_name, strftime(b.dom, '%Y-%m-%d') AS dom, m.name AS manufacturer,
              h.process_name AS process, h.unit_operation_name AS unit_operation,
              h.parameter_name AS parameter, r.value
       FROM result_next r JOIN batch_next b ON r.batch_id = b.batch_id
       JOIN m_manufacturer m ON b.manufacturer_id = m.manufacturer_id
       JOIN m_hier h ON r.parameter_id = h.parameter_id
       WHERE b.batch_name IN (SELECT DISTINCT "Batch Name" FROM clean)
       ORDER BY 1, 4, 5, 6"""))
def _review_loaded(st: State) -> DataFrame:
    return st.load.review.select("batch_name", _iso("dom"), "manufacturer", "process",
                                 "unit_operation", "parameter", "value")


@check("load_dry_run", with_ctes(
    """SELECT 'batch' AS table_name, count(*) AS row_count FROM m_batch
       UNION ALL SELECT 'result', count(*) FROM m_result""", upto="model"))
def _load_dry_run(st: State) -> DataFrame:
    store = ModelStore(scratch_path(st.spark, "store"))
    store.publish({k: v for k, v in st.model.items() if k != "rejected_records"}, run_id="migration")
    recurring_load(st.clean, store.read_model())  # dry run: computed, never published
    after = store.read_model()
    return after["batch"].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("batch").alias("table_name"), "row_count").unionByName(
        after["result"].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("result").alias("table_name"), "row_count"))


@check("stream_intake", with_ctes("SELECT result_id, batch_id, parameter_id, value FROM result_next"))
def _stream_intake(st: State) -> DataFrame:
    """The upload folder as a stream: the unique valid rows arrive as CSV files,
    one micro-batch validates, loads and publishes them into a store holding
    the migrated history; the stored result table is the load's next state."""
    store = ModelStore(scratch_path(st.spark, "stream-store"), st.spark)
    store.publish({k: v for k, v in st.model.items() if k != "rejected_records"}, run_id="history")
    folder = scratch_path(st.spark, "stream-uploads")
    (st.clean.select(*REQUIRED_COLUMNS).write.option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(folder))
    start_intake(st.spark, folder, store, scratch_path(st.spark, "stream-ckpt")).awaitTermination()
    return store.read("result").select("result_id", "batch_id", "parameter_id", "value")


# Audit (R-1, U-4) ----------------------------------------------------------------

@check("reject_audit", with_ctes(
    f"""SELECT row_number() OVER (ORDER BY rejection_hash) AS rejected_id, rejection_stage,
               source_file, rejection_hash
        FROM (SELECT DISTINCT rejection_stage, 'all_parts.csv' AS source_file,
                     {_hash_sql("'all_parts.csv'")} AS rejection_hash
              FROM rejected)""", upto="stage"))
def _reject_audit(st: State) -> DataFrame:
    one_file = materialize(st.upload.withColumn("source_file", F.lit("all_parts.csv")), "one_file")
    doubled = one_file.unionByName(one_file)
    ts = fx.ts(fx.VALIDATION_TS)
    first = validate_uploads(doubled, st.model, run_ts=ts)
    # A second run over the same input must add nothing.
    again = audit_rejections(first.staged, materialize(first.audit, "audit"), ts)
    return again.next_state.select("rejected_id", "rejection_stage", "source_file", "rejection_hash")


# Constraint checks (Q-1 to Q-3) -----------------------------------------------------

@check("check_unique", with_ctes(
    """SELECT "Batch Name", count(*) AS record_count
       FROM (SELECT DISTINCT "Batch Name", "Manufacturer", "DoM" FROM upload)
       WHERE "Batch Name" IS NOT NULL GROUP BY "Batch Name" HAVING count(*) > 1""", upto="upload"))
def _check_unique(st: State) -> DataFrame:
    cand = st.upload.select("Batch Name", "Manufacturer", "DoM").distinct()
    return duplicate_keys(cand, ["Batch Name"])


@check("check_not_null", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM upload"
        for c in SUBMISSION), upto="upload"))
def _check_not_null(st: State) -> DataFrame:
    return null_counts(st.upload, SUBMISSION)


@check("check_foreign_key", with_ctes(
    """SELECT result_id, batch_id, parameter_id FROM result_next r
       WHERE NOT EXISTS (SELECT 1 FROM m_batch b WHERE b.batch_id = r.batch_id)"""))
def _check_foreign_key(st: State) -> DataFrame:
    return dangling_references(st.load.model["result"], "batch_id", st.model["batch"], "batch_id") \
        .select("result_id", "batch_id", "parameter_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
