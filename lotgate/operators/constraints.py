"""Constraint checks the store would have enforced (Q-1, Q-2, Q-3, A-4).

Plain Parquet enforces no key, NOT NULL or foreign key, so the jobs check the
next state before publishing and raise instead of writing a bad state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotgate.schemas import KEYS, RESULT_NAME_KEYS


class ConstraintViolation(ValueError):
    """Raised before publish when a next state breaks a declared constraint."""


class DuplicateResultsError(ValueError):
    """Raised by the load when one batch/parameter is submitted more than once."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def duplicate_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys held by more than one row; keys whose parts are all NULL are skipped (Q-1)."""
    any_set = None
    for k in key_cols:
        c = F.col(k).isNotNull()
        any_set = c if any_set is None else any_set | c
    return (
        df.filter(any_set)
        .groupBy(*key_cols)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter(F.col("record_count") > 1)
    )


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with its NULL count, all counted in one pass (Q-2)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")


def dangling_references(child: DataFrame, column: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row (Q-3)."""
    keys = parent.select(F.col(parent_col).alias("_fk_parent"))
    return child.filter(F.col(column).isNotNull()).join(
        keys, child[column] == keys["_fk_parent"], "left_anti")


def duplicate_results(valid: DataFrame) -> DataFrame:
    """Batch/parameter name combinations submitted more than once, sorted (A-4, O-2)."""
    return (
        valid.groupBy(*RESULT_NAME_KEYS)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter(F.col("record_count") > 1)
        .orderBy(*RESULT_NAME_KEYS)
    )


def has_rows(df: DataFrame) -> bool:
    return len(df.take(1)) > 0


def constraint_report(model: dict[str, DataFrame]) -> list[str]:
    """Human-readable list of every violated constraint in *model*."""
    problems: list[str] = []
    for name, keys in KEYS.items():
        if name not in model:
            continue
        table = model[name]
        for key in (keys.business_key, (keys.id_col,)):
            if has_rows(duplicate_keys(table, list(key))):
                problems.append(f"{name}: duplicate {', '.join(key)}")
        for row in null_counts(table, list(keys.not_null)).filter("null_count > 0").collect():
            problems.append(f"{name}: {row['null_count']} NULL in {row['column_name']}")
        for column, parent, parent_col in keys.foreign_keys:
            if parent in model and has_rows(dangling_references(table, column, model[parent], parent_col)):
                problems.append(f"{name}: {column} without a row in {parent}")
    return problems


def check_constraints(model: dict[str, DataFrame]) -> None:
    problems = constraint_report(model)
    if problems:
        raise ConstraintViolation("; ".join(problems))


def check_inserted(inserted: dict[str, DataFrame]) -> None:
    """Key and NOT NULL checks on freshly inserted rows only, all tables in one job.

    Stored rows were checked when they were published and the insert anti
    join keeps new keys apart from them, so checking the delta suffices and
    never rescans a large table.
    """
    parts = []
    for name, table in inserted.items():
        keys = KEYS[name]
        bk = list(keys.business_key)
        nulls = [F.count_if(F.col(c).isNull()) for c in keys.not_null]
        per_key = table.groupBy(*bk).agg(
            F.count(F.lit(1)).alias("_n"),
            (sum(nulls[1:], nulls[0]) if nulls else F.lit(0)).alias("_z"))
        parts.append(per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("most"),
            F.coalesce(F.sum("_z"), F.lit(0)).cast("long").alias("nulls"),
        ))
    if not parts:
        return
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    problems: list[str] = []
    for row in report.collect():
        keys = KEYS[row["table_name"]]
        if row["most"] > 1:
            problems.append(f"{row['table_name']}: duplicate {', '.join(keys.business_key)} in inserted rows")
        if row["nulls"]:
            problems.append(f"{row['table_name']}: {row['nulls']} NULL in {', '.join(keys.not_null)}")
    if problems:
        raise ConstraintViolation("; ".join(problems))
