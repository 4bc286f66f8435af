"""Quality flags and row predicates; every flag is TRUE or FALSE, never null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions.text import has_digit, has_value


def _known(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def missing(value: Column) -> Column:
    return value.isNull()


def unknown_result(code: Column) -> Column:
    return ~_known(code.isin(S.ACCEPTED_RESULTS))


def unknown_summary(code: Column) -> Column:
    return ~_known(code.isin(S.POSITIVE, S.NEGATIVE))


def missing_dob(first: Column, last: Column, dob: Column, strict: bool = False) -> Column:
    """Names given and free of digits, but no birth date.

    ``strict`` keeps the rule as first written: it asks for null names and for a digit
    test on them at once, which no row can pass.
    """
    if strict:
        return _known((~has_digit(first) | ~has_digit(last))
                      & first.isNull() & last.isNull() & dob.isNull())
    return (has_value(first) & has_value(last) & dob.isNull()
            & ~_known(has_digit(first)) & ~_known(has_digit(last)))


def any_flag(df: DataFrame, mark: str = "qa_") -> Column:
    """TRUE when any column whose name contains ``mark`` is true."""
    flags = [_known(F.col(c)) for c in df.columns if mark in c]
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def wants_id_match(first: Column, last: Column) -> Column:
    """A digit in either name: the sender probably put a record number there."""
    return _known(has_digit(first)) | _known(has_digit(last))


def reportable(result: Column, summary: Column) -> Column:
    """Positive, and not the control target."""
    return summary.contains(S.POSITIVE) & (result != S.CONTROL_RESULT)
