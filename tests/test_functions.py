"""Scalar semantics: number text (D2), change test (D3, D4), missing tokens (D6),
dates (D7, D8), trims (D9) and the blank test (P-5)."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lotgate.functions import (
    PANDAS_NA_TOKENS, canonical_value, is_blank, na_to_null, parse_dom, strip_whitespace,
    trim_spaces, values_differ,
)


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r.x for r in df.select(expr(F.col("v")).alias("x")).collect()]


NUMBER_TEXTS = [
    "10", "10.0", "1e7", "0.0001", "1e-5", "1e-6", "1e16", "1e17", "0", "123.456", "1.5e-05",
    "1e400", "-1e400", "0.1", "1e-4", "-2.5E3", ".5", "5.", "+3", "9999999.5", "12345678.25",
    "0.00012345", "3.14159e10", "-0.001", "1234567", "2.5e-300", "7e22",
]


@pytest.mark.parametrize("text", NUMBER_TEXTS)
def test_number_text_matches_double_cast(spark, text):
    expected = duckdb.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [text]).fetchone()[0]
    assert one(spark, canonical_value, [text]) == [expected]


@pytest.mark.parametrize("text", ["abc", "5d", "1f", "12 kg", "0x1A", "", "1,5"])
def test_non_number_text_kept(spark, text):
    assert one(spark, canonical_value, [text]) == [text]


@pytest.mark.parametrize("text", ["9007199254740993", "12345678901234567891", "-9007199254740993", "00123", "-007", "1" * 45])
def test_integers_a_double_would_change_are_kept(spark, text):
    assert one(spark, canonical_value, [text]) == [text]


@pytest.mark.parametrize("exp", range(-6, 18))
def test_powers_of_ten(spark, exp):
    text = f"1e{exp}"
    expected = duckdb.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [text]).fetchone()[0]
    assert one(spark, canonical_value, [text]) == [expected]


# D4: the null-safe table of the load.
@pytest.mark.parametrize("old,new,changed", [
    ("10", "20", True), ("10", "10", False), (None, "10", True), ("10", None, True), (None, None, False),
    # D3: numbers compare numerically, other text as text.
    ("10", "10.0", False), ("10.0", "1e1", False), ("abc", "abc", False), ("abc", "ABC", True),
    ("5d", "5.0", True),
    # Integers beyond a double's precision are compared exactly.
    ("9007199254740992.0", "9007199254740993", True), ("9007199254740993", "9007199254740993", False),
    ("12345678901234567891", "12345678901234567890", True), ("00123", "123.0", False), ("00123", "00124", True),
    ("1" * 45, "1" * 44 + "2", True),
])
def test_values_differ(spark, old, new, changed):
    df = spark.createDataFrame([(old, new)], "a string, b string")
    assert df.select(values_differ(F.col("a"), F.col("b")).alias("x")).first().x is changed


def test_na_tokens_become_null(spark):
    values = PANDAS_NA_TOKENS + ["NA ", "na", "value", "  "]
    got = one(spark, na_to_null, values)
    assert got[: len(PANDAS_NA_TOKENS)] == [None] * len(PANDAS_NA_TOKENS)
    assert got[len(PANDAS_NA_TOKENS):] == ["NA ", "na", "value", "  "]


# D8: the date texts, against the source system's parser where it is defined.
DATE_TEXTS = [
    "5/1/26", "5/1/226", "005/1/2026", "2/29/2024", "2/30/2026", "2/29/2023", "13/1/2026",
    "1/1/2026x", "12/7/2026", " 8/1/2026 ", "08/01/2026", " 8/1/2026", "\t8/1/2026",
    "8/1/2026\n", "1/1/10000", "", "8 /1/2026",
]


@pytest.mark.parametrize("text", DATE_TEXTS)
def test_parse_dom_matches_strptime(spark, text):
    exp = duckdb.execute("SELECT CAST(try_strptime(trim(?), '%m/%d/%Y') AS DATE)", [text]).fetchone()[0]
    assert one(spark, parse_dom, [text]) == [exp]


def test_year_zero_is_invalid(spark):
    # Deliberate divergence: year 0 is not a date a client can read back.
    assert one(spark, parse_dom, ["1/1/0", "1/1/0000"]) == [None, None]


def test_trim_unicode_spaces_not_tabs(spark):
    got = one(spark, trim_spaces, ["  a  ", "\ta\t", " a", None])
    assert got == ["a", "\ta\t", "a", None]


def test_strip_whitespace_all(spark):
    assert one(spark, strip_whitespace, ["\t 8/1/2026 \r\n", " x "]) == ["8/1/2026", "x"]


def test_blank(spark):
    got = one(spark, is_blank, [None, "", "  ", " ", "\t", "a", " a "])
    assert got == [True, True, True, True, False, False, False]


def test_large_integral_doubles_take_the_nearest_shortest_spelling(spark):
    # From 1e16 up a double is an integer; a tie in the JVM's 17th digit must
    # not decide the spelling.
    import random
    rnd = random.Random(11)
    texts = ["9.777363671587188e+17", "8.253012333566932e+17", "1e16", "-2.5e17", "9.1e18"]
    texts += [repr(rnd.uniform(1, 9.2) * 10 ** rnd.randint(16, 18)) for _ in range(300)]
    got = one(spark, canonical_value, texts)
    exp = [duckdb.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [t]).fetchone()[0] for t in texts]
    assert got == exp
