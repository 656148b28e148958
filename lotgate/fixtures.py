"""Submission frames derived from the driver's tables (FIXTURES.md section 4).

``flat`` has one row per lineitem: the order is the batch, the part's type,
brand and name are process, unit operation and parameter, the supplier picked
by ``o_custkey % count(supplier)`` is the manufacturer and the quantity is the
value.  ``hist`` is the history to migrate, ``upload`` a later submission
with planted errors and corrections, ``clean`` the valid rows made unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotgate.schemas import REQUIRED_COLUMNS, RESULT_NAME_KEYS

# The timestamps the fixture jobs run at.
MIGRATION_TS = "2026-01-01 00:00:00"
VALIDATION_TS = "2026-02-01 00:00:00"


def ts(text: str):
    return F.to_timestamp(F.lit(text))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_suppliers = supplier.count()
    # The supplier is joined to the orders, which are fewer and narrower than the
    # line items, and the orders come last, so that hist groups where its rows are.
    o = orders.withColumn("_supp", F.col("o_custkey") % F.lit(n_suppliers))
    o = o.join(supplier, o["_supp"] == supplier["s_suppkey"])
    return (
        li.join(part, li["l_partkey"] == part["p_partkey"])
        .join(o, li["l_orderkey"] == o["o_orderkey"])
        .select(
            F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("Batch Name"),
            F.col("s_name").alias("Manufacturer"),
            F.date_format("o_orderdate", "M/d/yyyy").alias("DoM"),
            F.col("p_type").alias("Process"),
            F.col("p_brand").alias("Unit Operation"),
            F.col("p_name").alias("Parameter"),
            F.col("l_quantity").cast("string").alias("Value"),
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        )
    )


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter"]
    return (
        flat(spark, sf_dir).filter(F.col("l_orderkey") % 4 != 0)
        # The batch name has the order key in it: grouping by both changes no
        # group, and rows joined by the order key need no further shuffle.
        .groupBy("l_orderkey", *keys).agg(F.max("Value").alias("Value"))
        .select(*REQUIRED_COLUMNS)
    )


def upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flat(spark, sf_dir).filter((F.col("l_orderkey") % 4).isin(0, 1))
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    even_line = ln % 2 == 0
    return f.select(
        F.when(ok % 23 == 0, F.when(even_line, F.lit(None).cast("string")).otherwise(F.lit("  ")))
         .otherwise(F.col("Batch Name")).alias("Batch Name"),
        F.when(ok % 19 == 0, F.lit("Unknown Maker"))
         .when((ok % 29 == 0) & even_line, F.lit("Supplier X"))
         .otherwise(F.col("Manufacturer")).alias("Manufacturer"),
        F.when(pk % 31 == 0, F.lit("2/30/2026"))
         .when((ok % 37 == 0) & (ok % 4 == 1), F.lit("1/1/1990"))
         .otherwise(F.col("DoM")).alias("DoM"),
        F.when(pk % 17 == 0, F.lit("Unknown Process")).otherwise(F.col("Process")).alias("Process"),
        F.when(pk % 13 == 0, F.lit("Brand#999")).otherwise(F.col("Unit Operation")).alias("Unit Operation"),
        F.when(pk % 11 == 0, F.lit("no such parameter")).otherwise(F.col("Parameter")).alias("Parameter"),
        F.when(ok % 5 == 0, (F.col("l_quantity") + 1).cast("string"))
         .otherwise(F.col("Value")).alias("Value"),
        F.concat(F.lit("part_"), (ok % 3).cast("string"), F.lit(".csv")).alias("source_file"),
    )


def clean(valid: DataFrame) -> DataFrame:
    """Valid rows made unique on the four name keys (max of the other fields)."""
    return valid.groupBy(*RESULT_NAME_KEYS).agg(
        F.max("Manufacturer").alias("Manufacturer"),
        F.max("DoM").alias("DoM"),
        F.max("Value").alias("Value"),
        F.max("source_file").alias("source_file"),
        F.max("load_timestamp").alias("load_timestamp"),
    )
