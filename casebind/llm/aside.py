"""Columns an operator only passes on, put aside so that their names cannot clash with its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "rest"


def packed(docs: DataFrame, *used: str, **more: Column) -> DataFrame:
    """``used`` columns, ``more`` made from the whole row, and all others in one column."""
    others = [c for c in docs.columns if c not in used]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias(REST)] if others else []
    return docs.select(*[F.col(f"`{c}`") for c in used],
                       *(v.alias(k) for k, v in more.items()), *rest)


def unpacked(columns: list[str], used: tuple[str, ...]) -> list[Column]:
    """The columns as they were, to select from what was packed."""
    return [F.col(f"`{c}`") if c in used else F.col(REST)[c].alias(c) for c in columns]
