"""Text helpers: missing-value tokens, trims and the blank test (F-1, F-10, P-5, D6, D9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# SQL TRIM in the source system strips Unicode space separators (category Zs),
# not tabs or newlines.
_SPACE_EDGES = r"^\p{Zs}+|\p{Zs}+$"
# Python's str.strip() strips every Unicode whitespace character.
_WHITESPACE_EDGES = r"(?U)^[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+$"


def na_to_null(c: Column) -> Column:
    """Map the pandas missing-value tokens to NULL (D6)."""
    return F.when(c.isin(PANDAS_NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def trim_spaces(c: Column) -> Column:
    """TRIM of Unicode space separators at both ends (F-1, D9)."""
    # Of ASCII text in one line, TRIM strips the same without a search.
    plain = (F.octet_length(c) == F.length(c)) & ~F.contains(c, F.lit("\n")) & ~F.contains(c, F.lit("\r"))
    return F.when(plain, F.trim(c)).otherwise(F.regexp_replace(c, _SPACE_EDGES, ""))


def strip_whitespace(c: Column) -> Column:
    """Strip all whitespace at both ends, as ``str.strip`` does (F-10)."""
    # Text of visible ASCII characters only has nothing to strip.
    return F.when(c.rlike(r"\A[!-~]*\z"), c).otherwise(F.regexp_replace(c, _WHITESPACE_EDGES, ""))


def is_blank(c: Column) -> Column:
    """NULL or empty after trimming (P-5)."""
    return c.isNull() | c.rlike(r"^\p{Zs}*$")
