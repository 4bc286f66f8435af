"""Ledger tables: append-only batches of Parquet with whole-table snapshots.

Every write goes to a directory of its own and counts only once Spark has put its ``_SUCCESS``
mark there, so a job that dies half-way leaves the table as it was, and a table is never
overwritten while it is being read.

Tables whose rows are open until something resolves them are partitioned by that flag and by a
bucket of the key: open rows are read by partition pruning, and resolving some rewrites only the
open partitions of the buckets they are in.

Which keys a table holds is kept beside it (``key_index``), so an insert reads no ledger.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebind.operators.frames import align_schema, quote
from casebind.operators.history import KEY, absent_rows, flag_resolved
from casebind.operators.skew import HotKeys
from casebind.settings import FLAGGED_TABLES, LEDGER_SCHEMAS, MATCH_FLAG
from casebind.sources.key_index import Batch, KeyIndex, names_in
from casebind.sources.staging import counted

_VERSION = re.compile(r"^(?:version=)?v(\d+)-(part|full|patch)$")
BUCKET, VERSION = "_bucket", "version"
#: Buckets of a flagged table: what one run resolves should lie in a part of them, and a bucket's
#: open rows should fill a file.
BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Ledger:
    """Ledger tables in a shared folder, with fixed schemas."""

    def __init__(self, spark: SparkSession, folder: str, schemas: Mapping[str, str] = LEDGER_SCHEMAS,
                 flagged: Sequence[str] = FLAGGED_TABLES, buckets: int = BUCKETS):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas
        self.flagged, self.buckets = frozenset(flagged), buckets

    def _list(self, path: str) -> list[str]:
        return names_in(self.spark, path)

    def _versions(self, table: str) -> list[tuple[int, str, str]]:
        """(number, kind, directory) of every write that was begun."""
        return sorted((int(m[1]), m[2], m[0]) for name in self._list(f"{self.folder}/{table}")
                      if (m := _VERSION.match(name)))

    def _complete(self, table: str) -> list[tuple[int, str, str]]:
        """The last complete snapshot and the complete writes after it."""
        done = [v for v in self._versions(table)
                if "_SUCCESS" in self._list(f"{self.folder}/{table}/{v[2]}")]
        start = max((n for n, kind, _ in done if kind == "full"), default=0)
        return [v for v in done if v[0] >= start]

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], self.schemas[table])

    def newest(self, table: str) -> int:
        """The number of the last complete write; 0 if there is none."""
        return max((n for n, _, _ in self._complete(table)), default=0)

    def read(self, table: str, after: int = 0) -> DataFrame:
        """The rows of the table as they are now.

        Of an append-only table, ``after`` a write: what later writes brought, at least (after a
        compaction, everything).
        """
        done = [v for v in self._complete(table) if v[0] > after]
        return self._rows(table, done) if done else self._empty(table)

    def _rows(self, table: str, done: list[tuple[int, str, str]]) -> DataFrame:
        """What these complete writes brought."""
        root = f"{self.folder}/{table}"
        if table not in self.flagged:
            return self.spark.read.schema(self.schemas[table]).parquet(*[f"{root}/{d}" for _, _, d in done])
        return self._flagged(table, done).drop(BUCKET, VERSION)

    def _flagged(self, table: str, done: list[tuple[int, str, str]]) -> DataFrame:
        """Rows of a flagged table with bucket and version: open rows of a bucket count from the
        last write that replaced the open rows of this bucket. All this is decided on partition
        values, before a file is opened."""
        latest = {}
        for _, kind, name in done:
            if kind == "patch":  # it holds a resolved row of every bucket it replaces
                for bucket in self._list(f"{self.folder}/{table}/{name}/{MATCH_FLAG}=true"):
                    latest[int(bucket.partition("=")[2])] = name.partition("=")[2]
        names = [name.partition("=")[2] for _, _, name in done]
        rows = (self.spark.read.schema(f"{self.schemas[table]}, {BUCKET} int, {VERSION} string")
                .parquet(f"{self.folder}/{table}").filter(F.col(VERSION).isin(names)))
        if latest:
            since = F.create_map(*[F.lit(x) for item in latest.items() for x in item])
            since = F.coalesce(F.try_element_at(since, F.col(BUCKET)), F.lit(""))
            rows = rows.filter(F.coalesce(F.col(MATCH_FLAG), F.lit(True)) | (F.col(VERSION) >= since))
        return rows.select(*[quote(f.name) for f in self._empty(table).schema], BUCKET, VERSION)

    def open_rows(self, table: str) -> DataFrame:
        """The rows of a flagged table that nothing has resolved yet."""
        return self.read(table).filter(~F.col(MATCH_FLAG))

    def _write(self, table: str, rows: DataFrame, kind: str) -> int:
        """Write, and count the rows on their way: no job of its own."""
        number = max((n for n, _, _ in self._versions(table)), default=0) + 1
        rows, told = counted(self._bucketed(table, rows))
        name = f"v{number:06d}-{kind}"
        if table not in self.flagged:
            rows.write.parquet(f"{self.folder}/{table}/{name}")
        else:
            rows.write.partitionBy(MATCH_FLAG, BUCKET).parquet(f"{self.folder}/{table}/{VERSION}={name}")
        return told()["rows"]

    def _bucketed(self, table: str, rows: DataFrame) -> DataFrame:
        """As the table stores them: a flagged table's with their bucket, one file for each."""
        rows = align_schema(rows, self.schemas[table])
        if table not in self.flagged:
            return rows
        return rows.withColumn(BUCKET, bucket_of(KEY, self.buckets)).hint("rebalance", BUCKET)

    def append(self, table: str, rows: DataFrame) -> int:
        """Append rows as they are, none if there are none."""
        return 0 if rows.isEmpty() else self._write(table, rows, "part")

    def insert_if_absent(self, table: str, batch: DataFrame,
                         key: str | Sequence[str] = KEY, hot: HotKeys | None = None) -> int:
        """Append the batch rows whose key the table lacks, and count them; running it twice adds
        nothing.

        Rows with a null in their key are always appended. Neither the table is read nor its keys
        are shuffled: only keys that the batch has as well meet its rows. The batch is computed
        once and kept in the checkpoint folder meanwhile.
        """
        batch, keys = align_schema(batch, self.schemas[table]), [key] if isinstance(key, str) else list(key)
        if self._begun(table):
            kept = Batch(batch, keys)
            known, batch = self._known(table, kept), kept.rows
            if known is not None:
                batch = absent_rows(batch, kept.among(known), keys, hot)
        return self._write(table, batch, "part")

    def _begun(self, table: str) -> bool:
        return bool(self._complete(table))

    def _known(self, table: str, batch: Batch) -> DataFrame | None:
        """The keys of the table in the buckets of the batch, from an index that is brought up to
        the last write first; None if there are none. Patches bring no keys."""
        done = {n: (n, kind, d) for n, kind, d in self._complete(table) if kind != "patch"}
        index = KeyIndex(self.spark, f"{self.folder}/{table}/_keys", batch.keys)
        index.cover(list(done), lambda numbers: self._rows(table, [done[n] for n in numbers]))
        kinds = self._empty(table).select(*[quote(k) for k in batch.keys]).schema
        return index.known(min(done), batch, ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in kinds))

    def resolve(self, table: str, resolved: DataFrame, hot: HotKeys | None = None) -> int:
        """Set the flag of the open rows whose key is among ``resolved``; the buckets rewritten.

        Only open rows are looked at, and only the buckets that hold one of the keys are written;
        without any, nothing is.
        """
        rows = self.open_rows(table).withColumn(BUCKET, bucket_of(KEY, self.buckets))
        keys = resolved.select(KEY).distinct()
        hit = rows.select(KEY, BUCKET).join(keys, KEY, "left_semi").select(BUCKET).distinct()
        touched = [r[BUCKET] for r in hit.collect()]  # at most one number a bucket
        if touched:
            self._replace_open(table, flag_resolved(rows.filter(F.col(BUCKET).isin(touched)), keys, hot))
        return len(touched)

    def _replace_open(self, table: str, rows: DataFrame) -> None:
        self._write(table, rows, "patch")

    def replace(self, table: str, rows: DataFrame) -> None:
        """Make ``rows`` the whole table; they may be derived from the table itself."""
        self._write(table, rows, "full")

    def compact(self, table: str) -> None:
        """One snapshot instead of many batches: for every so many runs. Older directories stay
        until someone removes them, as a job may still be reading them."""
        self.replace(table, self.read(table))


class CatalogLedger(Ledger):
    """The same tables in the session catalog, under ``prefix`` (``catalog.schema.``).

    Appends go through ``insertInto``. A replacement is written to a staging table and copied
    in from there, as a table cannot be overwritten from itself. The copy is not atomic: if it
    dies half-way the whole rows are in the staging table of that replacement, which is dropped
    only afterwards. Flagged tables are partitioned by bucket; resolving rows overwrites the
    buckets they are in, open and closed rows of each.
    """

    def __init__(self, spark: SparkSession, prefix: str, schemas: Mapping[str, str] = LEDGER_SCHEMAS,
                 flagged: Sequence[str] = FLAGGED_TABLES, buckets: int = BUCKETS):
        super().__init__(spark, "", schemas, flagged, buckets)
        self.prefix = prefix

    def _name(self, table: str) -> str:
        name = f"{self.prefix}{table}"
        if not self.spark.catalog.tableExists(name):
            split = f", {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET})" \
                if table in self.flagged else ") USING parquet"
            self.spark.sql(f"CREATE TABLE {name} ({self.schemas[table]}{split}")
        return name

    def newest(self, table: str) -> int:
        return 0  # a catalog table does not tell its writes apart

    def _begun(self, table: str) -> bool:
        return True

    def _known(self, table: str, batch: Batch) -> DataFrame | None:
        """The keys of the table itself: without numbered writes there is no telling what an index
        covers."""
        return self.read(table)

    def read(self, table: str, after: int = 0) -> DataFrame:
        return self.spark.table(self._name(table)).drop(BUCKET)

    @contextmanager
    def _dynamic(self):
        """Within, an overwrite replaces the partitions that it has rows of."""
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(mode, before)

    def _write(self, table: str, rows: DataFrame, kind: str) -> int:
        name = self._name(table)
        rows, told = counted(self._bucketed(table, rows))
        if kind == "part":
            rows.write.insertInto(name)
            return told()["rows"]
        staged = f"{name}_staged_{uuid.uuid4().hex[:12]}"
        rows.write.saveAsTable(staged)
        if kind == "patch":
            with self._dynamic():
                self.spark.table(staged).write.insertInto(name, overwrite=True)
        else:
            self.spark.table(staged).write.insertInto(name, overwrite=True)
        self.spark.sql(f"DROP TABLE {staged}")
        return told()["rows"]

    def _replace_open(self, table: str, rows: DataFrame) -> None:
        """With the closed rows of the same buckets, as a bucket is one partition here."""
        touched = rows.select(BUCKET).distinct()
        closed = (self.spark.table(self._name(table)).filter(F.coalesce(F.col(MATCH_FLAG), F.lit(True)))
                  .join(F.broadcast(touched), BUCKET, "left_semi"))
        self._write(table, rows.unionByName(closed), "patch")
