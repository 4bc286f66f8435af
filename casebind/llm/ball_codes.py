"""Compressing vectors to codes of learned codebooks, by ball k-means.

A vector is cut into parts, each part position has a codebook, and each part is replaced by the
index of its nearest entry. The parts of one entry form a ball around it. Ball k-means spares most
comparisons: with d the distance of a part to the entry that it was with before,

* only entries whose distance to that entry is at most twice the ball's radius are neighbours;
* a part for which even the nearest neighbour is more than 2 d away from the entry stays: the
  ball's stable core;
* between half the distances to successive neighbours lie annular rings: a part in the t-th ring
  can only go to the first t neighbours, and is compared with exactly these.

The first round knows no ball and compares with all entries. All numbers are whole and below
2**53 for components below 2048 in magnitude, so double arithmetic is exact and ties are settled
as told: to the lower index.

Each round is one pass over the vectors. It writes every vector's codes, and each task's sums by
entry, to one table in the shared folder; the next round starts from those files. What reaches the
driver, and is sent to the tasks, is a codebook: entries x components, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebind.operators.skew import lookup_join
from casebind.sources.staging import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_MOST = (1 << 31) - 1
_RING_STEP = 2  # parts are compared together if their rings differ by less than this factor


@dataclass
class Codebook:
    """The entries of one part position, and the neighbours of each within its ball's reach."""

    entries: np.ndarray
    neighbours: list[np.ndarray] | None = None  # nearest first
    gaps: list[np.ndarray] | None = None  # their squared distances

    @classmethod
    def with_balls(cls, entries: np.ndarray, radius: np.ndarray) -> Codebook:
        """``radius``: at least the distance of every part of an entry to it."""
        gap = np.rint(((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2))
        order = np.argsort(gap, axis=1, kind="stable")
        neighbours, gaps = [], []
        for i, near in enumerate(order):
            near = near[near != i]
            near = near[gap[i, near] <= 4 * radius[i] ** 2]
            neighbours.append(near)
            gaps.append(gap[i, near])
        return cls(entries, neighbours, gaps)

    def _closest(self, parts: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest of the entries ``among``, given ascending."""
        entries = self.entries[among]
        far = (entries ** 2).sum(axis=1) - 2 * (parts @ entries.T)
        at = far.argmin(axis=1)
        return among[at], (parts ** 2).sum(axis=1) + far[np.arange(len(parts)), at]

    def nearest(self, parts: np.ndarray, home: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry, ties to the lower index.

        ``home`` is the entry each part was with when the balls were measured.
        """
        if home is None or self.neighbours is None:
            return self._closest(parts, np.arange(len(self.entries)))
        code, far = home.copy(), ((parts - self.entries[home]) ** 2).sum(axis=1)
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.diff(home[order])) + 1
        for ball in np.split(order, cuts):
            if not len(ball):
                continue
            i = home[ball[0]]
            ring = np.searchsorted(self.gaps[i], 4 * far[ball], side="right")
            ball, ring = ball[ring > 0], ring[ring > 0]  # the rest is the stable core
            by_ring = np.argsort(ring, kind="stable")
            ball, ring = ball[by_ring], ring[by_ring]
            start = 0
            while start < len(ball):
                stop = int(np.searchsorted(ring, max(ring[start] * _RING_STEP, 8), side="left"))
                stop = max(stop, start + 1)
                among = np.sort(np.append(self.neighbours[i][:ring[stop - 1]], i))
                rows = ball[start:stop]
                code[rows], far[rows] = self._closest(parts[rows], among)
                start = stop
        return code, far


class _Sums:
    """Of the parts of one task by part position and entry: count, components, greatest distance."""

    def __init__(self, books: Sequence[Codebook]):
        self.n = [np.zeros(len(b.entries), np.int64) for b in books]
        self.total = [np.zeros(b.entries.shape, np.int64) for b in books]
        self.far = [np.zeros(len(b.entries), np.int64) for b in books]

    def add(self, p: int, parts: np.ndarray, code: np.ndarray, far: np.ndarray) -> None:
        order = np.argsort(code, kind="stable")
        used, start = np.unique(code[order], return_index=True)
        self.n[p] += np.bincount(code, minlength=len(self.n[p]))
        self.total[p][used] += np.add.reduceat(parts[order].astype(np.int64), start, axis=0)
        self.far[p][used] = np.maximum(
            self.far[p][used], np.maximum.reduceat(far[order].astype(np.int64), start))

    def rows(self) -> list[tuple[int, int, int, int, list[int]]]:
        return [(p, int(i), int(self.n[p][i]), int(self.far[p][i]), self.total[p][i].tolist())
                for p in range(len(self.n)) for i in np.flatnonzero(self.n[p])]


def _binary(a: np.ndarray, width: int) -> pa.Array:
    """Each row of ``a`` as ``width`` bytes."""
    offsets = np.arange(len(a) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(a), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(a).tobytes())])


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """floor(``SCALE`` x) of the components of each row's list."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * SCALE), -_MOST - 1, _MOST).astype(np.int32).reshape(-1, dims)


def _pass(rows: DataFrame, books: Sequence[Codebook], label: str, first: bool, last: bool) -> DataFrame:
    """One round over ``keep``, ``v`` and, but for the first, ``codes``; written to the shared folder.

    The first round gets lists as ``v``. All but the last also return the sums of each task, as
    rows with ``part`` set.
    """
    dims = sum(b.entries.shape[1] for b in books)
    keep = T.StructField("keep", rows.schema["keep"].dataType)  # null in the rows of sums
    fields = [keep, T.StructField("codes", T.BinaryType())]
    if last:
        fields += [T.StructField("error", T.LongType())]
    else:
        fields += [T.StructField("v", T.BinaryType()), T.StructField("part", T.IntegerType()),
                   T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
                   T.StructField("far", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kind = _Sums(books), None
        for batch in batches:
            kind, n = batch.column("keep").type, batch.num_rows
            if not n:
                continue
            v = _vectors(batch.column("v"), dims) if first else np.frombuffer(
                b"".join(batch.column("v").to_pylist()), np.int32).reshape(-1, dims)
            homes = None if first else np.frombuffer(
                b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, len(books))
            codes, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, np.int64)
            for p, (book, part) in enumerate(zip(books, np.split(v, len(books), axis=1), strict=True)):
                part = part.astype(np.float64)
                code, far = book.nearest(part, None if first else homes[:, p].astype(np.intp))
                codes[:, p], error = code, error + far.astype(np.int64)
                if not last:
                    sums.add(p, part, code, far)
            made = [batch.column("keep"), _binary(codes, len(books))]
            if last:
                made.append(pa.array(error))
            else:
                made += [_binary(v, 4 * dims), *(pa.nulls(n, t) for t in (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(made, names)
        if not last and (told := sums.rows()):
            part, entry, n, far, total = (list(c) for c in zip(*told, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), kind), pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.binary()),
                 pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()),
                 pa.array(far, pa.int64()), pa.array(total, pa.list_(pa.int64()))], names)

    columns = ["keep", "v"] if first else ["keep", "v", "codes"]
    return staged(rows.select(*columns).mapInArrow(run, T.StructType(fields)), label)


def _moved(state: DataFrame, books: Sequence[Codebook]) -> list[Codebook]:
    """Each entry at the floored mean of its parts; where it has none it stays."""
    told = (state.where("part IS NOT NULL").select("part", "entry", "n", "far", F.posexplode("total"))
            .groupBy("part", "entry", "pos")
            .agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.sum("col").alias("total")).toArrow())
    part, entry, pos, n, far, total = (told[c].to_numpy() for c in ("part", "entry", "pos", "n", "far", "total"))
    out = []
    for p, book in enumerate(books):
        own = part == p
        entries, radius = book.entries.copy(), np.zeros(len(book.entries))
        entries[entry[own], pos[own]] = total[own] // n[own]
        radius[entry[own]] = np.sqrt(far[own])
        shift = np.sqrt(((entries - book.entries) ** 2).sum(axis=1))
        # every part is that near to the entry's new place; a little more for the roots' rounding
        out.append(Codebook.with_balls(entries, (radius + shift) * (1 + 1e-9) + 1e-6))
    return out


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """The rows of ``vectors`` that have a whole vector, with their codes.

    Rows whose vector is null, or holds null or non-finite components, are dropped. A component x
    becomes floor(1024 x). The codebook of each part position starts as that part of the
    ``entries`` (256 at most) vectors with the smallest ``key`` (null last; equal ones by their
    components), then ``rounds`` times parts are assigned and entries moved to the floored mean;
    after that parts are assigned once more. Returns all columns but ``vector``, and ``code`` (two
    hex digits a part), ``error`` (squared distances, summed over parts), ``label_error`` (error
    summed over the rows of one ``label``, nulls together) and ``codebooks_sha256``; columns of
    these names are replaced. Vectors whose length is not that of the first start entry, which is
    the smallest key's vector of a length that ``parts`` divides, stay as rows with null code and
    error. Repeated rows are coded alike. Components beyond 2,097,152 count as that.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    added = ("code", "error", "label_error", "codebooks_sha256")
    names = [c for c in vectors.columns if c != vector and c not in added]
    own = F.col(f"`{vector}`")
    whole = vectors.where(own.isNotNull() & F.forall(
        own, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)))
    fitting = whole.where((F.size(own) > 0) & (F.size(own) % parts == 0))
    order = (F.col(f"`{key}`").asc_nulls_last(), own.asc())
    lead = fitting.orderBy(*order).select(F.size(own).alias("dims")).first()
    dims = lead["dims"] if lead else 0
    seeds = [] if not lead else [r["v"] for r in whole.where(F.size(own) == dims).orderBy(*order)
                                 .limit(entries).select(own.alias("v")).collect()]
    keep = F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("_")).alias("keep")
    rows = whole.where(F.size(own) == dims).select(keep, own.cast("array<double>").alias("v"))
    books: list[Codebook] = []
    if seeds:
        start = _vectors(pa.array(seeds, pa.list_(pa.float64())), dims).astype(np.float64)
        books = [Codebook(np.ascontiguousarray(b)) for b in np.split(start, parts, axis=1)]
        state = rows
        for k in range(rounds):
            state = _pass(state, books, f"codes-{k}", first=k == 0, last=False)
            books, state = _moved(state, books), state.where("part IS NULL")
        coded = _pass(state, books, "codes", first=rounds == 0, last=True)
    else:
        coded = rows.limit(0).select("keep", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
    odd = whole.where(F.size(own) != dims).select(
        keep, F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"))
    coded = coded.union(odd).select(
        "keep", F.lower(F.hex("codes")).alias("code"), "error",
        F.when(F.col("keep")[label].isNull(), "").otherwise(
            F.concat(F.lit("="), F.col("keep")[label].cast("string"))).alias("name"))
    sums = coded.groupBy("name").agg(F.sum("error").alias("label_error"))
    text = ",".join(str(int(x)) for b in books for x in b.entries.ravel())
    return lookup_join(coded, sums, ["name"]).select(
        *[F.col("keep")[c].alias(c) for c in names], "code", "error", "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
