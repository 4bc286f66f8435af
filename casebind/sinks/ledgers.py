"""Routing a run's buckets into the ledger tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.operators.frames import keep_one, union_all
from casebind.operators.history import KEY, absent_rows
from casebind.operators.skew import HotKeys
from casebind.settings import CUMULATIVE, CUMULATIVE_COLUMNS, PACKAGE, PACKAGE_ROUTES, Deployment
from casebind.sources.ledger import Ledger

Routes = Iterable[tuple[str, str]]


def route_outputs(ledger: Ledger, buckets: Mapping[str, DataFrame],
                  routes: Routes = PACKAGE_ROUTES, hot: HotKeys | None = None) -> dict[tuple[str, str], int]:
    """Append every bucket to its table; submissions a table has already are left alone.

    Returns the rows appended, by bucket and table, which the writes have counted.
    """
    return {(bucket, table): ledger.insert_if_absent(table, buckets[bucket], KEY, hot)
            for bucket, table in routes if bucket in buckets}


def routed_rows(targets: Mapping[str, DataFrame], buckets: Mapping[str, DataFrame],
                routes: Routes = PACKAGE_ROUTES, hot: HotKeys | None = None) -> dict[str, DataFrame]:
    """What ``route_outputs`` would append to each table, without writing."""
    out: dict[str, DataFrame] = {}
    for bucket, table in routes:
        target = targets[table].select(KEY)
        if table in out:
            target = union_all(target, out[table].select(KEY))
        rows = absent_rows(buckets[bucket], target, [KEY], hot)
        out[table] = rows if table not in out else out[table].unionByName(
            rows, allowMissingColumns=True)
    return out


def write_rematch(ledger: Ledger, review: DataFrame, exact: DataFrame, resolved: DataFrame,
                  at: Deployment = PACKAGE, hot: HotKeys | None = None) -> int:
    """Append the matches, then flag the open non-matches that found a case now; the buckets of
    the non-match table rewritten.

    The flags are written last: a run that dies before them simply tries the rows again.
    """
    ledger.insert_if_absent(at.reviews, review, hot=hot)
    ledger.insert_if_absent(at.rematched, exact, hot=hot)
    return ledger.resolve(at.no_match, resolved, hot)


def cumulative(ledger: Ledger, rostered: str, table: str = CUMULATIVE) -> DataFrame:
    """One row per submission over everything ever rostered, kept up to date.

    The least row of each submission is kept as a snapshot that names the last write of
    ``rostered`` it covers; merging it with what came after gives what aggregating the whole
    ledger would, as the least of least rows is the least. A run that died before this leaves its
    rows to the next one.
    """
    before, newest = ledger.read(table), ledger.newest(rostered)
    covered = before.agg(F.max("through")).first()[0] or 0
    rows = union_all(before.select(*CUMULATIVE_COLUMNS),
                     ledger.read(rostered, covered).select(*CUMULATIVE_COLUMNS))
    ledger.replace(table, keep_one(rows, [KEY]).withColumn("through", F.lit(newest)))
    return ledger.read(table).select(*CUMULATIVE_COLUMNS)
