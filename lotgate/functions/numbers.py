"""Number text: one canonical spelling and a type-aware change test (F-6, F-7, D1-D4).

Submitted values are read as text.  A value that is a number is stored in the
spelling the source system used for a double (``10`` -> ``10.0``,
``1e7`` -> ``10000000.0``, ``1e-5`` -> ``1e-05``, ``1e16`` -> ``1e+16``); any
other text is kept as submitted, and so are integers that a double would
change (``9007199254740993``, ``00123``).  Everything runs as JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal or scientific number; Spark's own cast also accepts forms
# such as "5d" or "1f", which must stay text.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def is_number_text(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def as_double(c: Column) -> Column:
    """The double a number text denotes, NULL for anything else."""
    return F.when(is_number_text(c), c.try_cast("double"))


def double_text(d: Column) -> Column:
    """Spell a double the way the source system casts DOUBLE to VARCHAR.

    The JVM already writes plain shortest digits in [1e-3, 1e7).  The long
    expression for all else stands in a lambda, which Spark leaves out of the
    generated code: compiled with it, the code of a row is too long for the JVM
    to optimise.
    """
    absd = F.abs(d)
    usual = (d == F.lit(0.0)) | ((absd >= F.lit(1e-3)) & (absd < F.lit(1e7)))
    return F.when(usual, d.cast("string")).when(d.isNotNull(), F.element_at(F.transform(F.array(d), _unusual_text), 1))


def _unusual_text(d: Column) -> Column:
    absd = F.abs(d)
    # Plain notation: exact decimal digits, trailing zeros dropped, ".0" kept.
    plain = F.regexp_replace(
        F.regexp_replace(d.cast("decimal(38,21)").cast("string"), "0+$", ""),
        r"\.$",
        ".0",
    )
    # Scientific notation: the shortest mantissa that reads back as the same
    # double (1.5e-05, 1e+16); the JVM's own text can carry a 17th digit.
    candidates = [F.format_string(f"%.{p}e", d) for p in range(17)]
    sci = F.coalesce(*[F.when(c.try_cast("double") == d, c) for c in candidates])
    # From 1e16 to below 2**63 a double is an exact integer: round that
    # integer (exact decimal arithmetic) to ever more digits and keep the
    # first that reads back as the same double, so ties in a 17th digit go
    # to the nearest neighbour as in the source system.
    whole = absd.cast("long").cast("decimal(20,0)")
    rounded = [F.round(whole, -k).cast("decimal(20,0)") for k in range(18, -1, -1)]
    shortest = F.coalesce(*[F.when(r.cast("double") == absd, r) for r in rounded]).cast("string")
    digits = F.regexp_replace(shortest, "0+$", "")
    big_sci = F.concat(
        F.when(d < 0, F.lit("-")).otherwise(F.lit("")),
        F.regexp_replace(F.regexp_replace(digits, "^(.)", "$1."), r"\.$", ""),
        F.lit("e+"),
        F.lpad((F.length(shortest) - 1).cast("string"), 2, "0"),
    )
    return (
        F.when(F.isnan(d), F.lit("nan"))
        .when(d == F.lit(float("inf")), F.lit("inf"))
        .when(d == F.lit(float("-inf")), F.lit("-inf"))
        .when((absd >= F.lit(1e-4)) & (absd < F.lit(1e16)), plain)
        .when((absd >= F.lit(1e16)) & (absd < F.lit(9.2e18)), big_sci)
        .otherwise(sci)
    )


def is_exact_integer_text(c: Column) -> Column:
    """Integer text that the spelling of its double could change: leading
    zeros, or more than the 15 significant digits that every double keeps."""
    return F.coalesce(c.rlike(r"^[+-]?(0[0-9]+|[1-9][0-9]{14,}[1-9]0*)$"), F.lit(False))


def canonical_value(c: Column) -> Column:
    """Number text in canonical double spelling, unless it is an integer that a
    double cannot hold; that and other text stay unchanged (D1, D2)."""
    return F.when(is_number_text(c) & ~is_exact_integer_text(c), double_text(c.try_cast("double"))).otherwise(c)


def values_differ(stored: Column, incoming: Column) -> Column:
    """The change test (D3, D4): numeric when both sides are numbers, else
    null-safe text inequality.  Never raises."""
    both_numbers = is_number_text(stored) & is_number_text(incoming)
    doubles_differ = stored.try_cast("double") != incoming.try_cast("double")
    # Integers that a double cannot hold are compared digit by digit.
    digits_differ = F.coalesce(stored.try_cast("decimal(38,6)") != incoming.try_cast("decimal(38,6)"), stored != incoming)
    exact = is_exact_integer_text(stored) | is_exact_integer_text(incoming)
    return (F.when(both_numbers & exact, digits_differ).when(both_numbers, doubles_differ)
            .otherwise(~stored.eqNullSafe(incoming)))
