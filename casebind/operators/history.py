"""Anti and semi joins against what earlier runs recorded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.operators.skew import HotKeys, lookup_join

KEY = "submission_number"


def not_yet_rostered(submissions: DataFrame, rostered: DataFrame, hot: HotKeys | None = None,
                     with_date: bool = False) -> DataFrame:
    """Submissions without a rostered case; optionally matched on collection date too."""
    done = rostered.filter(F.col("CASE_ID").isNotNull())
    if with_date:
        done = done.select(KEY, F.col("submitted_collection_date").alias("SPECIMEN_COLLECTION_DTTM"))
    else:
        done = done.select(KEY)
    return lookup_join(submissions, done.distinct(), done.columns, "left_anti", hot)


def semi_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str,
              hot: HotKeys | None = None) -> DataFrame:
    """Mark the rows whose key is in ``keys``."""
    marked = keys.select(*on).distinct().withColumn(flag, F.lit(True))
    return lookup_join(df, marked, on, "left", hot).withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False)))


def absent_rows(batch: DataFrame, target: DataFrame, on: Sequence[str] = (KEY,),
                hot: HotKeys | None = None) -> DataFrame:
    """Batch rows whose key the target lacks.

    Keys repeated inside the batch all stay, and so do null keys. Where rows are spread, their input
    partition alone decides, so a batch that comes from a shuffle brings only the columns that are
    read.
    """
    return lookup_join(batch, target.select(*on).distinct(), on, "left_anti", hot, spread_by=())


def flag_resolved(ledger: DataFrame, resolved: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Set ``match_found`` on the open rows whose key is among ``resolved``; drop nothing."""
    columns = ledger.columns
    flagged = semi_flag(ledger, resolved, [KEY], "_resolved", hot)
    is_open = ~F.col("match_found")
    return flagged.withColumn(
        "match_found", F.when(is_open, F.col("_resolved")).otherwise(F.col("match_found"))
    ).select(*columns)
