"""Side tables with nothing but the keys of a ledger table, bucketed by their hash.

An insert has to know which keys of its batch a table holds. Here it learns that without reading
the table: it opens the buckets that the batch's keys fall into, skips row groups outside of the
batch's range by their statistics (files are sorted by key; numbers given out in order lie in few
of them), and meets what is left with the batch's keys in a semi join, whose small side Spark
broadcasts, or makes a Bloom filter of. What leaves the join is no more than the batch has keys.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebind.operators.frames import quote
from casebind.sources.staging import counted, staged

_DONE = re.compile(r"^v(\d+)$")
_BUCKET = "_key_bucket"
#: A batch tells which of these its keys fall into by the bits of one number: at most 64.
BUCKETS = 32


def names_in(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quote(k)) for k in keys]), F.lit(BUCKETS)).cast("int")


def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in keys])


class Batch:
    """A batch written down once, and what its keys are like, as counted by that write."""

    def __init__(self, rows: DataFrame, keys: Sequence[str]):
        self.keys, whole = list(keys), _whole(keys)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bucket(keys))
        ends = [end(F.when(whole, F.col(quote(k)))).alias(f"{end.__name__}_{n}")
                for n, k in enumerate(keys) for end in (F.min, F.max)]
        seen, told = counted(rows, F.bit_or(F.when(whole, bit)).alias("bits"), *ends)
        self.rows, self._told = staged(seen, "batch"), told()

    @property
    def buckets(self) -> list[int]:
        bits = self._told["bits"] or 0
        return [b for b in range(BUCKETS) if bits >> b & 1]

    def among(self, known: DataFrame) -> DataFrame:
        """The keys of ``known`` that the batch has."""
        for n, k in enumerate(self.keys):
            known = known.filter(F.col(quote(k)).between(*[
                F.lit(self._told[f"{end}_{n}"]) for end in ("min", "max")]))
        own = self.rows.filter(_whole(self.keys)).select(*[quote(k) for k in self.keys]).distinct()
        return known.select(*[quote(k) for k in self.keys]).join(own, self.keys, "left_semi")


class KeyIndex:
    """The keys of one table, in one directory for each stretch of writes that was indexed.

    ``v000007`` holds what the writes after the directory before brought, up to write 7. It counts
    once it has its ``_SUCCESS``; a dead one is written anew.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str]):
        self.spark, self.keys = spark, list(keys)
        self.folder = f"{folder}/{'-'.join(keys)}"

    def _directories(self, since: int) -> list[tuple[int, str]]:
        found = sorted((int(m[1]), f"{self.folder}/{name}") for name in names_in(self.spark, self.folder)
                       if (m := _DONE.match(name)))
        return [(n, d) for n, d in found if n >= since and "_SUCCESS" in names_in(self.spark, d)]

    def cover(self, writes: Sequence[int], read: Callable[[list[int]], DataFrame]) -> None:
        """Index the ``writes`` (ascending; the first is the snapshot the others follow) that are
        not yet: ``read`` gives the rows that some of them brought."""
        done = self._directories(writes[0])
        behind = [n for n in writes if not done or n > done[-1][0]]
        if not behind:
            return
        rows = read(behind).filter(_whole(self.keys)).select(*[quote(k) for k in self.keys]).distinct()
        (rows.withColumn(_BUCKET, _bucket(self.keys)).hint("rebalance", _BUCKET)
         .sortWithinPartitions(_BUCKET, *[quote(k) for k in self.keys])
         .write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.folder}/v{behind[-1]:06d}"))

    def known(self, since: int, batch: Batch, schema: str) -> DataFrame | None:
        """The keys in the batch's buckets; None if there are none."""
        paths = [f"{d}/{_BUCKET}={b}" for _, d in self._directories(since)
                 for b in {int(name.partition("=")[2]) for name in names_in(self.spark, d) if "=" in name}
                 .intersection(batch.buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None
