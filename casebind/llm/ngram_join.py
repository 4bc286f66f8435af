"""Jaccard self-join on word n-grams by MinHash banding, verified on full n-gram sets.

Equal texts form a class; only classes are compared. A class gets ``bands`` hashes of ``rows``
MinHash values each, numbers chosen for a target recall at the threshold. Classes that share a
band hash are candidates: each is tied to the least of them, which keeps a bucket of any size at
one edge a member, and the connected parts of these ties are clusters that hold every candidate
pair. Texts are shuffled once to their cluster, and there all pairs are verified on the full
n-gram sets, as counts of shared n-grams in an array, never as rows of pairs. A large cluster is
cut into chunks, and each pair of chunks is a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebind.llm.arrays import SPACED, bounds, mixed, pieces, shingles, words
from casebind.llm.aside import packed, unpacked
from casebind.llm.components import components
from casebind.sources.staging import staged

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
CHUNK_ROWS, CHUNK_BYTES = 1000, 4 << 20
MAX_HASHES = 160


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL,
              max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows whose band count for the recall stays within the hashes."""
    best = (max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1)
    for rows in range(2, 20):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _signatures(h: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands); texts without shingles must not be among them."""
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    odd = mixed(seeds) | np.uint64(1)
    out = np.empty((len(at) - 1, bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(at) - 1, b + 1, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15)
                        + np.minimum.reduceat((h ^ seeds[r]) * odd[r], at[:-1]))
        out[:, b] = key
    return out


def _similar(h: np.ndarray, doc: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Which of ``n`` texts resemble each other (n x n), from their sorted shingle sets."""
    sizes = np.bincount(doc, minlength=n).astype(np.float32)
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    head = np.append(np.flatnonzero(new), len(h))
    count = np.diff(head)
    shared = np.zeros((n, n), dtype=np.float32)
    few = 12
    for c in range(2, few):
        start = head[:-1][count == c]
        if len(start):
            members = doc[start[:, None] + np.arange(c)]
            for a in range(c):
                for b in range(c):
                    if a != b:
                        np.add.at(shared, (members[:, a], members[:, b]), 1)
    common = np.flatnonzero(count >= few)
    for k in range(0, len(common), 512):
        some = common[k:k + 512]
        held = np.zeros((n, len(some)), dtype=np.float32)
        for j, g in enumerate(some):
            held[doc[head[g]:head[g + 1]], j] = 1
        shared += held @ held.T
    # counts are whole numbers, exact in 32 bits; the products are compared with room for rounding
    alike = shared >= np.float32(threshold) * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
    np.fill_diagonal(alike, False)
    return alike


def _least(alike: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per text the least id it is connected to."""
    label = ids.copy()
    while True:
        reach = np.where(alike, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(label, reach)
        if (new == label).all():
            return label
        label = new


def _node() -> Column:
    """The id of a row, or a negative hash of its text if it has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), -F.abs(F.xxhash64(text) % (1 << 62)))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                    shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_copies, n_links, group_id.

    class_id is the least id with the same text, n_copies the rows of the class, n_links the
    number of other texts with a Jaccard similarity of the threshold or more, group_id the least
    class_id connected by such links. Words stand between white space; a text with fewer words
    than a shingle has one shingle of all. Texts without words (and nulls) link to nothing but
    are a class per text. A row without an id counts under a negative hash of its text; rows that
    share an id are one node for group_id.
    """
    bands, rows = bands_for(threshold, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                w = words(part.column("text"), SPACED)
                h, doc = shingles(w, shingle)
                has = np.unique(doc)
                keys = _signatures(h, bounds(doc, len(w.first) - 1)[np.append(has, len(w.first) - 1)]
                                   if len(has) else np.zeros(1, int), bands, rows)
                made: list[bytes | None] = [None] * part.num_rows
                for i, k in zip(has.tolist(), keys, strict=True):
                    made[i] = k.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("node"), part.column("text_hash"),
                     pa.array(made, pa.binary())], ["doc_id", "node", "text_hash", "bands"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rowed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _node().alias("node"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_hash"), text.alias("text"))
    signed = staged(rowed.mapInArrow(
        sign, "doc_id long, node long, text_hash binary, bands binary"), "signatures")
    classes = signed.groupBy("text_hash").agg(
        F.min("node").alias("class_id"), F.count("*").alias("n_copies"), F.first("bands").alias("bands"))
    classes = staged(classes, "classes")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.int64)
            nodes = np.repeat(batch.column("class_id").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])

    in_band = (classes.where("bands IS NOT NULL").select("class_id", "bands")
               .mapInArrow(spread, "key long, node long"))
    least = in_band.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v < w")
    ties = in_band.join(least, "key").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    tied = components(ties)
    members = tied.union(tied.select(F.col("root").alias("node"), "root").distinct())

    reps = classes.select(F.col("class_id").alias("node"), "text_hash")
    inside = staged(
        rowed.select("node", "text_hash", "text")
        .join(members.join(reps, "node"), ["node", "text_hash"])
        .select("root", "node", "text_hash", "text"), "clusters")
    sizes = inside.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    cut = F.greatest(F.ceil(F.col("n") / CHUNK_ROWS), F.ceil(F.col("b") / CHUNK_BYTES)).cast("int")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = sizes.select("root", cut.alias("chunks"))
    chunk = F.pmod(F.xxhash64("text_hash"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = (inside.join(sizes, "root").withColumn("chunk", chunk).withColumn("other", other)
             .select("root", "node", "text_hash", "text", "chunk", "chunks",
                     F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
             # small clusters share a group
             .withColumn("tile", F.when(F.col("chunks") > 1, F.xxhash64("root", "i", "j"))
                         .otherwise(F.pmod(F.xxhash64("root"), F.lit(64 * width)))))

    def verify(table: pa.Table) -> pa.Table:
        out = []
        roots = table["root"].to_numpy()
        lows, highs = table["i"].to_numpy(), table["j"].to_numpy()
        order = np.lexsort((highs, lows, roots))
        keys = np.column_stack([roots, lows, highs])[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        heads = np.append(np.flatnonzero(new), len(order))
        for a, b in zip(heads[:-1], heads[1:], strict=True):
            out += verified(table.take(pa.array(order[a:b])))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({k: pa.array(list(c), t) for (k, t), c in zip(
            (("node", pa.int64()), ("text_hash", pa.binary()), ("links", pa.int64()),
             ("least", pa.int64())), columns, strict=True)})

    def verified(t: pa.Table) -> list[tuple[int, bytes, int, int]]:
        """Links of the texts of one tile, and the least node each is connected to in it."""
        hashes = t["text_hash"].to_pylist()
        if len(set(hashes)) < len(hashes):  # repeated rows
            keep = list({x: k for k, x in enumerate(hashes)}.values())
            t, hashes = t.take(pa.array(keep)), [hashes[k] for k in keep]
        h, doc = shingles(words(t["text"], SPACED), shingle)
        alike = _similar(h, doc, len(hashes), threshold)
        i, j, chunk = (t[c].to_numpy() for c in ("i", "j", "chunk"))
        if i[0] != j[0]:  # pairs within a chunk belong to its own tile
            alike &= chunk[:, None] != chunk[None, :]
        links, ids = alike.sum(axis=1), t["node"].to_numpy()
        label = _least(alike, ids)
        return [(int(ids[k]), hashes[k], int(links[k]), int(label[k])) for k in np.flatnonzero(links)]

    found = staged(tiles.groupBy("tile").applyInArrow(
        verify, "node long, text_hash binary, links long, least long"), "links")
    groups = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")))
    links = found.groupBy("text_hash").agg(F.sum("links").alias("n_links"))
    of_class = (classes.drop("bands").join(links, "text_hash", "left")
                .join(groups.withColumnRenamed("node", "class_id"), "class_id", "left")
                .select("text_hash", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                        F.coalesce("root", "class_id").alias("group_id")))
    return (signed.select("doc_id", "node", "text_hash").join(of_class, "text_hash")
            .select("doc_id", "node", "class_id", "n_copies", "n_links", "group_id"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the least id. Columns stay.

    Ids that stand for different texts name no row: such rows count as rows without an id, so each
    text stays unless it is a near copy of another that does. Of repeated rows one stays.
    """
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    shared = staged(docs.where("doc_id IS NOT NULL").groupBy("doc_id")
                    .agg(F.min(text).alias("least"), F.max(text).alias("most"))
                    .where("least < most").select(F.col("doc_id").alias("_shared")), "shared-ids")
    own = (packed(docs, "doc_id", "text").join(shared, F.col("doc_id") == F.col("_shared"), "left")
           .withColumn("own", F.col("doc_id"))
           .withColumn("doc_id", F.when(F.col("_shared").isNull(), F.col("doc_id"))).withColumn("node", _node()))
    keep = (near_duplicates(own.select("doc_id", "text"), threshold)
            .where("node = group_id").select("node").distinct())
    first = Window.partitionBy("node").orderBy("own", F.xxhash64("text"))
    return (own.join(keep, "node").withColumn("turn", F.row_number().over(first)).where("turn = 1")
            .withColumn("doc_id", F.col("own")).select(*unpacked(docs.columns, ("doc_id", "text"))))
