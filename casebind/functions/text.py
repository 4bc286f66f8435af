"""Text helpers that agree with Unicode-aware regex engines."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# \d and \s in their Unicode meaning; Java regexes are ASCII-only by default
DIGIT = r"\p{Nd}"
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` drops spaces only)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def has_digit(text: Column) -> Column:
    return text.rlike(DIGIT)


def has_value(text: Column) -> Column:
    """TRUE for non-null, non-empty text; never null."""
    return F.coalesce(text != "", F.lit(False))


def name_clean(name: Column) -> Column:
    """Lower-case letters of any script, with their marks; digits, punctuation and spaces go."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{M}]", ""))


def lookup(value: Column, table: Mapping, default=None) -> Column:
    """Exact-match lookup in a small fixed table; a null or unknown value gives ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def literal_alternatives(pattern: str) -> list[str] | None:
    """The plain texts an ``a|b`` pattern looks for, or None if it is a real regex."""
    bare = re.sub(r"\\[(){}.\[\]]", "", pattern)
    if re.search(r"[\\^$.*+?()\[\]{}]", bare):
        return None
    return [re.sub(r"\\(.)", r"\1", part) for part in pattern.split("|")]


def occurs(text: Column, pattern: str) -> Column:
    """TRUE where the pattern is found anywhere in the text.

    Patterns made of plain texts become substring searches, many times cheaper per row than
    a regex.
    """
    plain = literal_alternatives(pattern)
    if plain is None:
        return text.rlike(pattern)
    return reduce(lambda a, b: a | b, [text.contains(p) for p in plain])


def split_field_slot(name: Column) -> tuple[Column, Column]:
    """``tsttyp2`` -> (``tsttyp``, 2); no digits gives a null slot."""
    digits = F.regexp_extract(name, r"(\d+)", 1)
    return (
        F.regexp_extract(name, r"([a-zA-Z]+)", 1),
        F.when(digits != "", digits.cast("int")),
    )
