"""Numbering all rows in a given order without putting one group of them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebind.sources.staging import staged

_SALT, _CUT, _AT, _BASE = "_salt", "_cut", "_at", "_base"
_IN_PARTITION = (1 << 33) - 1  # the low bits of a monotonically increasing id


def numbered(rows: DataFrame, order: Sequence[str], within: Sequence[str] = (),
             name: str = "number") -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... in ascending ``order`` within equal ``within``.

    Rows are dealt out by range of (within, order, salt), sorted and written once; the only thing
    brought together are the counts of each range. Rows that are equal in ``order`` follow each
    other in any order, the salt spreads them over ranges however many there are. Columns of
    ``within`` must not be null. ``rows`` is read twice (Spark samples it for the ranges), so an
    expensive one should be staged first.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*within, *order, _SALT]
    dealt = (rows.withColumn(_SALT, F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()))
             .repartitionByRange(width, *by).sortWithinPartitions(*by)
             .withColumns({_CUT: F.spark_partition_id(),
                           _AT: F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION)}))
    cut = staged(dealt.drop(_SALT), "numbered")
    counts = cut.groupBy(*within, _CUT).agg(F.count("*").alias("n"), F.min(_AT).alias("first"))
    before = Window.partitionBy(*within).orderBy(_CUT)
    bases = counts.select(*within, _CUT, (F.sum("n").over(before) - F.col("n") - F.col("first")).alias(_BASE))
    return (cut.join(bases, [*within, _CUT])
            .select(*[f"`{c}`" for c in rows.columns if c != name],
                    (F.col(_BASE) + F.col(_AT)).alias(name)))
