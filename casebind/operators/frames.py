"""General reshaping: schema alignment, one row per key, unions, column patterns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quote(name: str) -> str:
    return f"`{name}`"


def align_schema(df: DataFrame, target: StructType | str) -> DataFrame:
    """Project to the target's columns, order and types; missing ones null, extra ones dropped."""
    if isinstance(target, str):
        target = StructType.fromDDL(target)
    return df.select(*[
        (F.col(quote(f.name)) if f.name in df.columns else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in target
    ])


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The least row of each key, comparing the other columns left to right, nulls first.

    An aggregate rather than a window: each task keeps one row per key before the shuffle, so
    a key of any size fits.
    """
    rest = list(order or [])
    rest += [c for c in df.columns if c not in keys and c not in rest]
    return (
        df.groupBy(*[F.col(quote(k)) for k in keys])
        .agg(F.min(F.struct(*[F.col(quote(c)) for c in rest])).alias("_least"))
        .select(*[F.col(quote(c)) if c in keys else F.col(f"_least.{quote(c)}").alias(c)
                  for c in df.columns])
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames that have the same columns."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def union_diagonal(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name and fill what one side lacks with null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def columns_matching(df: DataFrame, pattern: str = "", dtype: str | None = None,
                     exclude: str | None = None) -> list[str]:
    """Column names by regex, by type, and without those that match ``exclude``."""
    return [
        name for name, kind in df.dtypes
        if re.search(pattern, name)
        and (dtype is None or kind == dtype)
        and (exclude is None or not re.search(exclude, name))
    ]


def dates_as_text(df: DataFrame, layout: str = "yyyy-MM-dd",
                  columns: Sequence[str] | None = None) -> DataFrame:
    names = columns if columns is not None else columns_matching(df, dtype="date")
    return df.withColumns({c: F.date_format(F.col(c), layout) for c in names}) if names else df
