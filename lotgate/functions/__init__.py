"""Column expressions shared by the operators; all run JVM-side."""

from lotgate.functions.audit import HASH_FIELDS, rejection_hash, row_json
from lotgate.functions.dates import parse_dom
from lotgate.functions.numbers import (
    as_double, canonical_value, double_text, is_number_text, values_differ,
)
from lotgate.functions.text import (
    PANDAS_NA_TOKENS, is_blank, na_to_null, strip_whitespace, trim_spaces,
)

__all__ = [
    "HASH_FIELDS", "PANDAS_NA_TOKENS", "as_double", "canonical_value", "double_text",
    "is_blank", "is_number_text", "na_to_null", "parse_dom", "rejection_hash",
    "row_json", "strip_whitespace", "trim_spaces", "values_differ",
]
