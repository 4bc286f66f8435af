"""Date parsing and weekday arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebind.functions.text import strip
from casebind.settings import DATE_PATTERNS, EXCEL_EPOCH

_A_MONDAY = "1970-01-05"
_TIME_OF_DAY = r"(?i)([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([AP]M)?(Z|[+-]\d{2}:?\d{2})?|(?<=^\d{5})\.\d+)$"
# "$" would let a line end pass
_NOTHING_ELSE = "|".join(shape.removesuffix("$") + r"\z" for shape, _ in DATE_PATTERNS)


def parse_date(text: Column) -> Column:
    """Date from any accepted spelling, or an Excel day number; anything else is null.

    White space around it, a time of day after it and a fraction of a day number are ignored.
    The spelling is recognised first, so each row goes through one date parser only.
    """
    return parse_bare_date(bare_date(text))


def bare_date(text: Column) -> Column:
    """Without white space around it and the time of day; what is nothing but a date is not
    searched for them."""
    text = text.cast("string")
    return F.when(text.rlike(_NOTHING_ELSE), text).otherwise(F.regexp_replace(strip(text), _TIME_OF_DAY, ""))


def parse_bare_date(text: Column) -> Column:
    """``parse_date`` of what ``bare_date`` leaves. Each spelling asks for the text anew, so where
    many rows are parsed it should be a column by then."""
    parsed = F.when(
        text.rlike(r"^\d{1,6}$"),
        F.date_add(F.lit(EXCEL_EPOCH).cast("date"), text.try_cast("int")),
    )
    for shape, layout in DATE_PATTERNS:
        parsed = parsed.when(
            text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)).cast("date"))
    return parsed


def _weekdays_up_to(day: Column) -> Column:
    offset = F.datediff(day, F.lit(_A_MONDAY).cast("date"))
    return F.floor(offset / 7) * 5 + F.least(F.pmod(offset, F.lit(7)) + 1, F.lit(5))


def business_days(a: Column, b: Column) -> Column:
    """Weekdays after the earlier date up to the later one, in either order; 0 when equal."""
    return F.abs(_weekdays_up_to(a) - _weekdays_up_to(b)).cast("bigint")
