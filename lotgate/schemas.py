"""Model tables: declared schemas, business keys and empty tables (S-12, section 1.2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The seven required submission columns.
REQUIRED_COLUMNS = [
    "Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter", "Value",
]
# The four name keys of one result in a submission.
RESULT_NAME_KEYS = ["Batch Name", "Process", "Unit Operation", "Parameter"]
# The three name levels of the process hierarchy.
HIERARCHY_NAMES = ["Process", "Unit Operation", "Parameter"]

TS = T.TimestampType()


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


SCHEMAS: dict[str, T.StructType] = {
    "manufacturer": T.StructType([
        _f("manufacturer_id", T.LongType(), False), _f("name", T.StringType(), False),
        _f("location", T.StringType()), _f("created_at", TS), _f("modified_at", TS),
    ]),
    "process": T.StructType([
        _f("process_id", T.LongType(), False), _f("process_name", T.StringType(), False),
        _f("created_at", TS), _f("modified_at", TS),
    ]),
    "unit_operation": T.StructType([
        _f("unit_operation_id", T.LongType(), False), _f("process_id", T.LongType(), False),
        _f("unit_operation_type", T.StringType()), _f("unit_operation_name", T.StringType()),
        _f("created_at", TS), _f("modified_at", TS),
    ]),
    "parameter": T.StructType([
        _f("parameter_id", T.LongType(), False), _f("unit_operation_id", T.LongType(), False),
        _f("parameter_name", T.StringType(), False), _f("units", T.StringType()),
        _f("lower_specification_limit", T.DoubleType()),
        _f("upper_specification_limit", T.DoubleType()),
        _f("created_at", TS), _f("modified_at", TS),
    ]),
    "batch": T.StructType([
        _f("batch_id", T.LongType(), False), _f("batch_name", T.StringType(), False),
        _f("dom", T.DateType()), _f("manufacturer_id", T.LongType()),
        _f("created_at", TS), _f("modified_at", TS),
    ]),
    "result": T.StructType([
        _f("result_id", T.LongType(), False), _f("batch_id", T.LongType(), False),
        _f("parameter_id", T.LongType(), False), _f("value", T.StringType()),
        _f("created_at", TS), _f("modified_at", TS),
    ]),
    "rejected_records": T.StructType([
        _f("rejected_id", T.LongType(), False), _f("rejection_stage", T.StringType(), False),
        _f("source_file", T.StringType()), _f("raw_data", T.StringType()),
        _f("rejection_hash", T.StringType(), False), _f("created_at", TS),
    ]),
}


@dataclass(frozen=True)
class TableKeys:
    id_col: str
    business_key: tuple[str, ...]
    not_null: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent id)


KEYS: dict[str, TableKeys] = {
    "manufacturer": TableKeys("manufacturer_id", ("name",), ("manufacturer_id", "name")),
    "process": TableKeys("process_id", ("process_name",), ("process_id", "process_name")),
    "unit_operation": TableKeys(
        "unit_operation_id", ("process_id", "unit_operation_name"),
        ("unit_operation_id", "process_id"), (("process_id", "process", "process_id"),),
    ),
    "parameter": TableKeys(
        "parameter_id", ("unit_operation_id", "parameter_name"),
        ("parameter_id", "unit_operation_id", "parameter_name"),
        (("unit_operation_id", "unit_operation", "unit_operation_id"),),
    ),
    "batch": TableKeys(
        "batch_id", ("batch_name",), ("batch_id", "batch_name"),
        (("manufacturer_id", "manufacturer", "manufacturer_id"),),
    ),
    "result": TableKeys(
        "result_id", ("batch_id", "parameter_id"), ("result_id", "batch_id", "parameter_id"),
        (("batch_id", "batch", "batch_id"), ("parameter_id", "parameter", "parameter_id")),
    ),
    "rejected_records": TableKeys(
        "rejected_id", ("rejection_hash",), ("rejected_id", "rejection_stage", "rejection_hash"),
    ),
}

# Tables whose size grows with the submitted data (never broadcast blindly).
GROWING_TABLES = {"batch", "result", "rejected_records"}

MODEL_TABLES = ["manufacturer", "process", "unit_operation", "parameter", "batch", "result"]


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def empty_model(spark: SparkSession) -> dict[str, DataFrame]:
    """All seven model tables, empty, with their declared types (S-12)."""
    return {name: empty_table(spark, name) for name in SCHEMAS}


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns in declared order and types; absent columns are NULL."""
    from pyspark.sql import functions as F

    cols = []
    for field in SCHEMAS[name].fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)
