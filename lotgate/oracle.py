"""Independent DuckDB SQL for the correctness gate.

Every check in ``lotgate.registry`` has a twin here, written the way a SQL
user would state the rule (EXISTS / NOT EXISTS, COUNT(DISTINCT ...),
ROW_NUMBER for ids), not as a transcription of the Spark plan.  The driver's
tables are pre-registered as views; everything else is a CTE.

Surrogate ids are compared directly because the Spark key assignment (K-1)
gives new rows ``max(existing id) + rank in business-key order``; here that is
``ROW_NUMBER() OVER (ORDER BY key)``.
"""

from __future__ import annotations

NUM_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"

# Submission rows derived from the driver's tables (FIXTURES.md section 4).
FLAT = """
flat AS (
  SELECT 'O' || CAST(o.o_orderkey AS VARCHAR) AS "Batch Name",
         s.s_name AS "Manufacturer",
         strftime(o.o_orderdate, '%-m/%-d/%Y') AS "DoM",
         p.p_type AS "Process",
         p.p_brand AS "Unit Operation",
         p.p_name AS "Parameter",
         CAST(l.l_quantity AS VARCHAR) AS "Value",
         l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON s.s_suppkey = o.o_custkey % (SELECT count(*) FROM supplier)
)"""

HIST = """
hist AS (
  SELECT "Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter",
         max("Value") AS "Value"
  FROM flat WHERE l_orderkey % 4 <> 0
  GROUP BY "Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter"
)"""

UPLOAD = """
upload AS (
  SELECT
    CASE WHEN l_orderkey % 23 = 0
         THEN CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE '  ' END
         ELSE "Batch Name" END AS "Batch Name",
    CASE WHEN l_orderkey % 19 = 0 THEN 'Unknown Maker'
         WHEN l_orderkey % 29 = 0 AND l_linenumber % 2 = 0 THEN 'Supplier X'
         ELSE "Manufacturer" END AS "Manufacturer",
    CASE WHEN l_partkey % 31 = 0 THEN '2/30/2026'
         WHEN l_orderkey % 37 = 0 AND l_orderkey % 4 = 1 THEN '1/1/1990'
         ELSE "DoM" END AS "DoM",
    CASE WHEN l_partkey % 17 = 0 THEN 'Unknown Process' ELSE "Process" END AS "Process",
    CASE WHEN l_partkey % 13 = 0 THEN 'Brand#999' ELSE "Unit Operation" END AS "Unit Operation",
    CASE WHEN l_partkey % 11 = 0 THEN 'no such parameter' ELSE "Parameter" END AS "Parameter",
    CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_quantity + 1 AS VARCHAR) ELSE "Value" END AS "Value",
    'part_' || CAST(l_orderkey % 3 AS VARCHAR) || '.csv' AS source_file
  FROM flat
  WHERE l_orderkey % 4 IN (0, 1)
)"""

# History migration (M-1) from empty tables: ids are the rank in key order.
MODEL = """
m_manufacturer AS (
  SELECT row_number() OVER (ORDER BY name) AS manufacturer_id, name
  FROM (SELECT DISTINCT "Manufacturer" AS name FROM hist)
),
m_process AS (
  SELECT row_number() OVER (ORDER BY process_name) AS process_id, process_name
  FROM (SELECT DISTINCT "Process" AS process_name FROM hist)
),
m_unit_operation AS (
  SELECT row_number() OVER (ORDER BY p.process_id, u."Unit Operation" NULLS FIRST) AS unit_operation_id,
         p.process_id, u."Unit Operation" AS unit_operation_name
  FROM (SELECT DISTINCT "Process", "Unit Operation" FROM hist) u
  JOIN m_process p ON u."Process" = p.process_name
),
m_parameter AS (
  SELECT row_number() OVER (ORDER BY u.unit_operation_id, x."Parameter") AS parameter_id,
         u.unit_operation_id, x."Parameter" AS parameter_name
  FROM (SELECT DISTINCT "Process", "Unit Operation", "Parameter" FROM hist) x
  JOIN m_process pr ON x."Process" = pr.process_name
  JOIN m_unit_operation u ON u.process_id = pr.process_id
                         AND u.unit_operation_name = x."Unit Operation"
),
m_batch AS (
  SELECT row_number() OVER (ORDER BY b."Batch Name") AS batch_id,
         b."Batch Name" AS batch_name,
         CAST(try_strptime(trim(b."DoM"), '%m/%d/%Y') AS DATE) AS dom,
         m.manufacturer_id
  FROM (SELECT DISTINCT "Batch Name", "Manufacturer", "DoM" FROM hist) b
  JOIN m_manufacturer m ON b."Manufacturer" = m.name
),
m_hier AS (
  SELECT pr.process_id, pr.process_name, u.unit_operation_id, u.unit_operation_name,
         pa.parameter_id, pa.parameter_name
  FROM m_process pr
  JOIN m_unit_operation u ON u.process_id = pr.process_id
  JOIN m_parameter pa ON pa.unit_operation_id = u.unit_operation_id
),
m_result AS (
  SELECT row_number() OVER (ORDER BY b.batch_id, h.parameter_id) AS result_id,
         b.batch_id, h.parameter_id, r."Value" AS value
  FROM hist r
  JOIN m_batch b ON r."Batch Name" = b.batch_name
  JOIN m_hier h ON r."Process" = h.process_name
               AND r."Unit Operation" = h.unit_operation_name
               AND r."Parameter" = h.parameter_name
)"""

# The gate, from the rule text: a row fails at the first rule it breaks. What a
# rule needs to know about a batch is worked out once per batch name and joined.
STAGE = """
dated AS (
  SELECT *, CAST(try_strptime(trim("DoM"), '%m/%d/%Y') AS DATE) AS day,
         coalesce(trim("Batch Name"), '') = '' AS nameless
  FROM upload
),
-- Batches that the upload itself describes in more than one way.
torn AS (
  SELECT DISTINCT "Batch Name" AS torn_name FROM (
    SELECT "Batch Name", min(trim("DoM")) <> max(trim("DoM")) AS two_days,
           min(trim("Manufacturer")) <> max(trim("Manufacturer")) AS two_makers
    FROM dated WHERE NOT nameless AND day IS NOT NULL GROUP BY "Batch Name")
  WHERE two_days OR two_makers
),
-- What the model holds about each stored batch.
kept AS (
  SELECT b.batch_name AS kept_name, b.dom AS kept_day, m.name AS kept_maker
  FROM m_batch b LEFT JOIN m_manufacturer m USING (manufacturer_id)
),
known_unit AS (SELECT DISTINCT process_name AS kp, unit_operation_name AS ku
               FROM m_process JOIN m_unit_operation USING (process_id)),
checked AS (
  SELECT d.*, torn_name IS NOT NULL AS is_torn,
         -- Only a manufacturer the model knows can contradict a stored batch.
         kept_name IS NOT NULL AND mk.name IS NOT NULL
           AND (kept_day IS DISTINCT FROM day OR kept_maker IS DISTINCT FROM d."Manufacturer") AS is_moved,
         mk.name IS NULL AS no_maker, pr.process_name IS NULL AS no_process, ku IS NULL AS no_unit,
         h.parameter_id IS NULL AS no_parameter
  FROM dated d
  LEFT JOIN torn ON torn_name = d."Batch Name"
  LEFT JOIN kept ON kept_name = d."Batch Name"
  LEFT JOIN m_manufacturer mk ON mk.name = d."Manufacturer"
  LEFT JOIN m_process pr ON pr.process_name = d."Process"
  LEFT JOIN known_unit ON kp = d."Process" AND ku = d."Unit Operation"
  LEFT JOIN m_hier h ON h.process_name = d."Process" AND h.unit_operation_name = d."Unit Operation"
                    AND h.parameter_name = d."Parameter"
),
staged AS (
  SELECT c.* EXCLUDE (day, nameless, is_torn, is_moved, no_maker, no_process, no_unit, no_parameter),
    CASE WHEN nameless THEN 'batch_name' WHEN day IS NULL THEN 'dom'
         WHEN is_torn OR is_moved THEN 'batch_metadata' WHEN no_maker THEN 'manufacturer'
         WHEN no_process THEN 'process' WHEN no_unit THEN 'unit_operation'
         WHEN no_parameter THEN 'parameter' END AS rejection_stage,
    CASE WHEN nameless OR day IS NULL THEN NULL WHEN is_torn THEN 'upload' WHEN is_moved THEN 'stored' END AS metadata_scope
  FROM checked c
),
valid AS (SELECT * FROM staged WHERE rejection_stage IS NULL),
rejected AS (SELECT * FROM staged WHERE rejection_stage IS NOT NULL)"""

# Recurring load (L-1) of the de-duplicated valid rows.
LOAD = f"""
clean AS (
  SELECT "Batch Name", "Process", "Unit Operation", "Parameter",
         max("Manufacturer") AS "Manufacturer", max("DoM") AS "DoM", max("Value") AS "Value"
  FROM valid
  GROUP BY "Batch Name", "Process", "Unit Operation", "Parameter"
),
new_batch AS (
  SELECT (SELECT coalesce(max(batch_id), 0) FROM m_batch)
           + row_number() OVER (ORDER BY batch_name) AS batch_id,
         batch_name, dom, manufacturer_id
  FROM (
    SELECT DISTINCT c."Batch Name" AS batch_name,
           CAST(try_strptime(trim(c."DoM"), '%m/%d/%Y') AS DATE) AS dom,
           m.manufacturer_id
    FROM clean c JOIN m_manufacturer m ON c."Manufacturer" = m.name
    WHERE NOT EXISTS (SELECT 1 FROM m_batch b WHERE b.batch_name = c."Batch Name")
  )
),
batch_next AS (
  SELECT batch_id, batch_name, dom, manufacturer_id FROM m_batch
  UNION ALL
  SELECT batch_id, batch_name, dom, manufacturer_id FROM new_batch
),
incoming AS (
  SELECT b.batch_id, h.parameter_id, c."Value" AS value
  FROM clean c
  JOIN batch_next b ON c."Batch Name" = b.batch_name
  JOIN m_hier h ON c."Process" = h.process_name
               AND c."Unit Operation" = h.unit_operation_name
               AND c."Parameter" = h.parameter_name
),
classified AS (
  SELECT i.batch_id, i.parameter_id, i.value, r.result_id, r.value AS old_value,
    CASE
      WHEN r.result_id IS NULL THEN 'new'
      WHEN CASE WHEN regexp_full_match(r.value, '{NUM_RE}') AND regexp_full_match(i.value, '{NUM_RE}')
                THEN CAST(r.value AS DOUBLE) <> CAST(i.value AS DOUBLE)
                ELSE r.value IS DISTINCT FROM i.value END
        THEN 'updated'
      ELSE 'unchanged'
    END AS action
  FROM incoming i
  LEFT JOIN m_result r ON r.batch_id = i.batch_id AND r.parameter_id = i.parameter_id
),
result_next AS (
  SELECT r.result_id, r.batch_id, r.parameter_id,
         CASE WHEN c.action = 'updated' THEN c.value ELSE r.value END AS value
  FROM m_result r
  LEFT JOIN classified c ON c.batch_id = r.batch_id AND c.parameter_id = r.parameter_id
  UNION ALL
  SELECT (SELECT coalesce(max(result_id), 0) FROM m_result)
           + row_number() OVER (ORDER BY batch_id, parameter_id) AS result_id,
         batch_id, parameter_id, value
  FROM classified WHERE action = 'new'
)"""

CHAIN = [("flat", FLAT), ("hist", HIST), ("upload", UPLOAD), ("model", MODEL),
         ("stage", STAGE), ("load", LOAD)]


def with_ctes(body: str, upto: str = "load") -> str:
    """``WITH <fixture CTEs up to *upto*> <body>``."""
    parts = []
    for name, text in CHAIN:
        parts.append(text.strip())
        if name == upto:
            break
    return "WITH " + ",\n".join(parts) + "\n" + body
