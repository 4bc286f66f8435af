"""Test items inside documents: size-partitioned MinHash containment search.

Items are partitioned by size (number of word shingles, in powers of two). For each size class
documents are cut into overlapping windows of twice the largest item of the class, so any passage
as long as an item lies in one window, and the resemblance of item and window is at least
0.8 / 4.2 however long the document. Each window's MinHash values are looked up among the items'
values (bands of one row): ``HASHES`` values miss a window with probability (1 - 0.19) ** 40,
2 in 10,000, in the worst case. What is found is verified on the exact shingle sets: the share of
the item's shingles that the whole document has.

Items whose index is below ``MAX_INDEX_BYTES`` travel to the tasks and documents need no shuffle.
Above, windows and items meet in a shuffle on (class, hash function, value).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.llm.arrays import ALPHANUMERIC, Words, bounds, mixed, pieces, windows, words
from casebind.llm.aside import packed, unpacked

SHINGLE, THRESHOLD, HASHES = 5, 0.8, 40
MAX_INDEX_BYTES = 32 << 20

_SEEDS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mixed(_SEEDS) | np.uint64(1)

Class = tuple[int, int]  # words in a shingle, largest number of shingle places of an item


def size_class(n_words: int) -> Class:
    """Short items have shingles of all their words; longer ones a class for each power of two."""
    n = min(SHINGLE, n_words)
    places = n_words - n + 1
    return n, 1 << places.bit_length()


def _places(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    h, whole = windows(w, n)
    at = np.flatnonzero(whole)
    return h[at], w.doc[at]


def _minima(h: np.ndarray, doc: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values (hash functions x windows) and the text of each window."""
    first = np.searchsorted(doc, doc)  # where each one's text begins
    start = np.flatnonzero((np.arange(len(h)) - first) % stride == 0)
    owner = doc[start]
    alone = np.ones(len(start), dtype=bool)
    pair = owner[1:] == owner[:-1]
    alone[1:] &= ~pair
    alone[:-1] &= ~pair
    left = np.concatenate([np.flatnonzero(pair), np.flatnonzero(alone)])
    right = np.concatenate([np.flatnonzero(pair) + 1, np.flatnonzero(alone)])
    out = np.empty((HASHES, len(left)), dtype=np.uint64)
    for k in range(HASHES if len(h) else 0):
        low = np.minimum.reduceat((h ^ _SEEDS[k]) * _ODD[k], start)
        out[k] = np.minimum(low[left], low[right])
    return out, owner[left]


class Index:
    """Items by size class: their MinHash values, and their exact shingles."""

    def __init__(self, ids: list[int | None], texts: pa.Array):
        w = words(texts, ALPHANUMERIC, lower=True)
        self.ids, self.shingles = ids, [np.zeros(0, np.uint64)] * len(ids)
        self.width = [min(SHINGLE, n) for n in w.counts().tolist()]
        by_class: dict[Class, list[int]] = {}
        for i, n in enumerate(w.counts().tolist()):
            if n:
                by_class.setdefault(size_class(n), []).append(i)
        self.classes: dict[Class, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for c, items in by_class.items():
            h, doc = _places(w, c[0])
            at = bounds(doc, len(ids))
            values = np.empty((HASHES, len(items)), dtype=np.uint64)
            for k, i in enumerate(items):
                own = np.unique(h[at[i]:at[i + 1]])
                self.shingles[i] = own
                values[:, k] = (((own[:, None] ^ _SEEDS) * _ODD).min(axis=0))
            order = np.argsort(values, axis=1)
            self.classes[c] = (list(np.take_along_axis(values, order, 1)), list(np.array(items)[order]))

    def candidates(self, w: Words) -> set[tuple[int, int]]:
        """(text, item) pairs that share a MinHash value in some window."""
        out: set[tuple[int, int]] = set()
        for (n, stride), (values, items) in self.classes.items():
            h, doc = _places(w, n)
            minima, owner = _minima(h, doc, stride)
            for known, which, now in zip(values, items, minima, strict=True):
                low, high = (np.searchsorted(known, now, side=s) for s in ("left", "right"))
                for k in np.flatnonzero(high > low):
                    out.update((int(owner[k]), int(i)) for i in which[low[k]:high[k]])
        return out


def _verified(w: Words, pairs: set[tuple[int, int]], index: Index,
              threshold: float) -> list[tuple[int, int | None, float]]:
    """Pairs at or above the threshold: text, item id, share of the item's shingles."""
    out, made = [], {}
    for n in {index.width[i] for _, i in pairs}:
        h, doc = _places(w, n)
        made[n] = (h, bounds(doc, len(w.first) - 1))
    for d, i in sorted(pairs):
        h, at = made[index.width[i]]
        own = index.shingles[i]
        share = float(np.isin(own, h[at[d]:at[d + 1]]).sum()) / len(own)
        if share >= threshold:
            out.append((d, index.ids[i], share))
    return out


def _pairs(doc_ids: list, found: list[tuple[int, int | None, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([doc_ids[d] for d, _, _ in found], pa.int64()),
         pa.array([i for _, i, _ in found], pa.int64()),
         pa.array([s for _, _, s in found], pa.float64())], ["doc_id", "item_id", "containment"])


_SCHEMA = "doc_id long, item_id long, containment double"


def find_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
               max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """(doc_id, item_id, containment) for every document row and item row at or above threshold.

    Words are runs of letters (A-Z lower-cased), digits and characters beyond ASCII; a shingle
    has five words, or all of a shorter item. Items without words match nothing, null texts are
    empty. Repeated rows give repeated pairs; null ids are carried along.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    index = _index(items, max_index_bytes)
    if index is None:
        return _shuffled(docs, items, threshold)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield _pairs(part.column("doc_id").to_pylist(), _search(part, index.value, threshold))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, _SCHEMA)


def _index(items: DataFrame, max_index_bytes: int) -> Broadcast[Index] | None:
    """The items' index for all tasks, or None if it may be larger than allowed."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    if size["n"] * HASHES * 16 + 4 * (size["b"] or 0) > max_index_bytes:
        return None
    rows = items.collect()  # size checked above
    return items.sparkSession.sparkContext.broadcast(
        Index([r["item_id"] for r in rows], pa.array([r["text"] for r in rows], pa.large_string())))


def _search(part: pa.RecordBatch, index: Index, threshold: float) -> list[tuple[int, int | None, float]]:
    w = words(part.column("text"), ALPHANUMERIC, lower=True)
    return _verified(w, index.candidates(w), index, threshold)


def _shuffled(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The same for items of any number: both sides' values are shuffled, texts by candidate."""
    classes = [tuple(r) for r in items.mapInArrow(_classes, "n int, stride int").distinct().collect()]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                w = words(part.column("text"), ALPHANUMERIC, lower=True)
                keys = np.array(part.column("key").to_pylist(), dtype=np.int64)
                for c in classes:
                    minima, owner = _minima(*_places(w, c[0]), c[1])
                    salt = mixed(_SEEDS + np.uint64(c[0] * (1 << 40) + c[1]))[:, None]
                    yield _values((minima ^ salt).ravel(), np.tile(keys[owner], HASHES))

    def item_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column("key").to_pylist(), dtype=np.int64)
            index = Index(keys.tolist(), batch.column("text"))
            for c, (known, which) in index.classes.items():
                salt = mixed(_SEEDS + np.uint64(c[0] * (1 << 40) + c[1]))[:, None]
                yield _values((np.array(known) ^ salt).ravel(), keys[np.array(which).ravel()])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words(part.column("text"), ALPHANUMERIC, lower=True)
                index = Index(part.column("item_id").to_pylist(), part.column("item"))
                pairs = {(k, k) for k in range(part.num_rows) if index.width[k]}
                yield _pairs(part.column("doc_id").to_pylist(), _verified(w, pairs, index, threshold))

    # rows are known by a hash of id and text: rows alike in both share their pairs
    key = F.xxhash64("doc_id", "text").alias("key")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("*", key)
    i = items.select("*", F.xxhash64("item_id", "text").alias("key"))
    near = (d.select("key", "text").mapInArrow(values, "value long, key long").distinct()
            .join(i.select("key", "text").mapInArrow(item_values, "value long, key long")
                  .distinct().withColumnRenamed("key", "item_key"), "value")
            .select("key", "item_key").distinct())
    texts = i.select(F.col("key").alias("item_key"), "item_id", F.col("text").alias("item"))
    return (d.join(near, "key").join(texts, "item_key").select("doc_id", "text", "item_id", "item")
            .mapInArrow(check, _SCHEMA))


def _values(value: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(key)], ["value", "key"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = words(batch.column("text"), ALPHANUMERIC, lower=True).counts()
        found = sorted({size_class(n) for n in counts.tolist() if n})
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int32()),
                                          pa.array([s for _, s in found], pa.int32())],
                                         ["n", "stride"])


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                  max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``docs`` without the rows that hold an item; rows without an id are judged like others.

    No shuffle while the items' index may travel.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    index = _index(items, max_index_bytes)
    if index is None:
        row = F.xxhash64("doc_id", "text")  # rows alike in both share their fate
        found = _shuffled(docs.select(row.alias("doc_id"), "text"), items, threshold)
        return (packed(docs, "doc_id", "text", row=row)
                .join(found.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti")
                .select(*unpacked(docs.columns, ("doc_id", "text"))))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[d for d, _, _ in _search(part, index.value, threshold)]] = False
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
