"""Audit expressions: the rejection hash and the row as JSON (F-3, F-4, F-5, F-8, S-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of the rejection hash, in hash order.
HASH_FIELDS = [
    "source_file", "rejection_stage", "Batch Name", "Manufacturer", "DoM",
    "Process", "Unit Operation", "Parameter", "Value",
]


def rejection_hash(fields: list[str] = HASH_FIELDS) -> Column:
    """md5 of the fields joined by ``|``, NULL read as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))


def row_json(df: DataFrame) -> Column:
    """Every column of the row as one JSON object, NULL fields kept (D17)."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
