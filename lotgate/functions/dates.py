"""Safe parse of the date-of-manufacture text (F-2, D7, D8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotgate.functions.text import trim_spaces

# Month and day take one or two digits, the year one to four (the source
# system's %m/%d/%Y accepts short years such as 26 or 226).
_DOM_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{1,4}$"
_ASCII_WS_EDGES = r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$"


def parse_dom(c: Column) -> Column:
    """``M/D/Y`` text to DATE, NULL when it does not parse.

    The shape guard rejects text the strict Spark parser would accept but the
    source system would not (three-digit months); the year is left-padded to
    four digits so short years parse; year 0 does not exist and is rejected.
    Only ``try_`` functions are used, so ANSI mode never raises.
    """
    # TRIM strips space separators; the parser then skips ASCII whitespace.
    # Text already in shape (the common case) skips both replacements.
    t = F.regexp_replace(trim_spaces(c), _ASCII_WS_EDGES, "")
    return F.when(c.rlike(_DOM_SHAPE), _shaped_date(c)).when(t.rlike(_DOM_SHAPE), _shaped_date(t))


def _shaped_date(t: Column) -> Column:
    """The DATE of text in shape: a cast reads year-month-day without a formatter."""
    t = F.regexp_replace(t, r"\n$", "")  # ``$`` lets a last line end pass
    year = F.lpad(F.substring_index(t, "/", -1), 4, "0")
    day = F.substring_index(F.substring_index(t, "/", 2), "/", -1)
    return F.when(year != F.lit("0000"), F.concat_ws("-", year, F.substring_index(t, "/", 1), day).try_cast("date"))
