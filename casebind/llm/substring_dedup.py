"""Removal of word passages that an earlier document holds, by hashes of word windows.

The corpus is cut into reference blocks of consecutive documents. Each block indexes its own
phrases (runs of ``n`` words, by a hash) and hands every index shard the phrases that fall into
it; a shard answers which of a block's phrases an earlier block holds, and which block that is.
With the answers, and the earlier documents of its own block, every word of a phrase that an
earlier document holds is marked and removed. That gives the exact result without a parse.

The column ``factors`` describes what was removed, and nothing is derived from it. It is no greedy
Lempel-Ziv parse: a factor is a run of phrases with the same earliest block, so a copy of one
document is split where a part of it occurs in a still earlier block, and neighbouring phrases from
two documents of one block make one factor that stands in neither.

At scale: text is shuffled once, by block, and the exchange serves both passes; phrases travel
as 7 bytes each; a block sends a phrase once however often it holds it, so a phrase that is in
every document has one entry for a block. Block and shard sizes are fixed, their numbers grow
with the input.

The 56 bits, the shard and the block order tell phrases apart: with 30 GB of text a shard
number adds 12 bits, which leaves the expected number of false matches below one in ten runs.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.llm.arrays import SPACED, Words, windows, words
from casebind.llm.blocks import NO_ID, block_of, block_starts, sort_id

_SHARD_FACTOR, _KEY_FACTOR = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by([("i", "ascending")])


class _Phrases:
    """Phrases of a block: distinct ones by shard and key, and where each occurs."""

    def __init__(self, w: Words, ids: np.ndarray, n: int, shards: int):
        shard, whole = windows(w, n, _SHARD_FACTOR)
        key, _ = windows(w, n, _KEY_FACTOR)
        known = whole & (ids[w.doc[:len(whole)]] != NO_ID)  # a text without an id has no order
        at = np.flatnonzero(known)
        shard = (shard[at] % np.uint64(shards)).astype(np.int64)
        key = key[at] >> np.uint64(8)
        order = np.lexsort((key, shard))  # stable: equal phrases stay in document order
        self.at, shard, key = at[order], shard[order], key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])
        self.head = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.key = key[self.head]
        self.shards, self.begin = np.unique(shard[self.head], return_index=True)
        self.begin = np.append(self.begin, len(self.head))
        #: occurrences that a smaller id in the same block precedes
        owner = ids[w.doc[self.at]]
        self.local = owner > owner[self.head][self.of] if len(owner) else np.zeros(0, dtype=bool)


def _packed(key: np.ndarray) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def parse(known: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Runs of phrases with one earliest block in a document: first word, words, block.

    ``known[i]`` is the block that holds the phrase from word ``i`` on, or -1.
    """
    out = []
    hits = np.flatnonzero(known >= 0)
    if not len(hits):
        return out
    new = np.ones(len(hits), dtype=bool)
    new[1:] = (np.diff(hits) > 1) | (np.diff(known[hits]) != 0)
    heads = np.append(np.flatnonzero(new), len(hits))
    for a, b in zip(heads[:-1], heads[1:], strict=True):
        out.append((int(hits[a]), int(b - a + n - 1), int(known[hits[a]])))
    return out


def dedup_substrings(docs: DataFrame, n: int = 13, block_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (its words but the duplicate spans,
    joined by one space) and factors (first word, words, reference block).

    A phrase is a duplicate if a row with a smaller doc_id has it. Rows with equal ids do not
    count as earlier than each other; a row without an id keeps all words and is no reference.
    A null text has no words. Texts below ``n`` words are kept. Other columns are ignored.
    """
    starts = block_starts(docs, block_bytes)
    shards = max(1, len(starts))
    block = block_of(starts)
    blocks = (docs.select(sort_id().alias("i"), F.col("text").cast("string").alias("text"))
              .withColumn("block", block("i")).groupBy("block"))

    def index(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = _in_order(table)
        p = _Phrases(words(table["text"], SPACED), table["i"].to_numpy(), n, shards)
        return pa.table({
            "shard": pa.array(p.shards, pa.int32()),
            "block": pa.array(np.full(len(p.shards), key[0].as_py()), pa.int32()),
            "keys": pa.array([_packed(p.key[a:b]) for a, b in
                              zip(p.begin[:-1], p.begin[1:], strict=True)], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending")])
        keys = [_unpacked(x) for x in table["keys"].to_pylist()]
        owners = table["block"].to_numpy()
        sizes = np.array([len(k) for k in keys])
        key, owner = np.concatenate(keys), np.repeat(owners, sizes)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        earliest = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        hit, ref = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=np.int32)
        hit[order], ref[order] = ~new, earliest
        ends = np.cumsum(sizes)
        rows = [(b, np.packbits(hit[e - s:e]).tobytes(), ref[e - s:e][hit[e - s:e]].tobytes())
                for b, s, e in zip(owners, sizes, ends, strict=True) if hit[e - s:e].any()]
        return pa.table({
            "block": pa.array([r[0] for r in rows], pa.int32()),
            "shard": pa.array(np.full(len(rows), table["shard"][0].as_py()), pa.int32()),
            "hits": pa.array([r[1] for r in rows], pa.binary()),
            "refs": pa.array([r[2] for r in rows], pa.binary())})

    def restore(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _in_order(table)
        w, ids = words(table["text"], SPACED), table["i"].to_numpy()
        p = _Phrases(w, ids, n, shards)
        elsewhere = np.full(len(p.head), -1, dtype=np.int32)
        span = dict(zip(p.shards.tolist(), zip(p.begin[:-1], p.begin[1:], strict=True), strict=True))
        for s, hits, refs in zip(*(answers[c].to_pylist() for c in ("shard", "hits", "refs")), strict=True):
            a, b = span[s]
            flags = np.unpackbits(np.frombuffer(hits, dtype=np.uint8), count=b - a).astype(bool)
            elsewhere[a:b][flags] = np.frombuffer(refs, dtype=np.int32)
        known = np.full(len(w.hash), -1, dtype=np.int32)
        found = elsewhere[p.of] if len(p.of) else elsewhere
        found = np.where((found < 0) & p.local, key[0].as_py(), found)
        known[p.at] = found
        edge = np.zeros(len(w.hash) + 1, dtype=np.int32)
        begin = np.flatnonzero(known >= 0)
        edge[begin] += 1
        np.add.at(edge, begin + n, -1)
        removed = np.cumsum(edge[:-1]) > 0
        kept, factors, gone = [], [], []
        raw = w.data.tobytes() if removed.any() else b""
        for d, text in enumerate(table["text"].to_pylist()):
            a, b = w.first[d], w.first[d + 1]
            cut = removed[a:b]
            gone.append(int(cut.sum()))
            if not gone[-1]:
                kept.append(b" ".join((text or "").encode().split()).decode())
                factors.append([])
                continue
            spans = zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)
            kept.append(b" ".join(raw[s:e] for s, e in compress(spans, ~cut)).decode())
            factors.append([dict(zip(("first_word", "n_words", "ref_block"), f, strict=True))
                            for f in parse(known[a:b], n)])
        return pa.table({
            "doc_id": pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()),
            "n_words": pa.array(w.counts(), pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "kept": pa.array(kept, pa.string()),
            "factors": pa.array(factors, pa.list_(pa.struct([
                ("first_word", pa.int64()), ("n_words", pa.int64()), ("ref_block", pa.int32())])))})

    indexed = blocks.applyInArrow(index, "shard int, block int, keys binary")
    answers = indexed.groupBy("shard").applyInArrow(
        answer, "block int, shard int, hits binary, refs binary")
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(
        restore, "doc_id long, n_words long, n_removed long, kept string, "
                 "factors array<struct<first_word: long, n_words: long, ref_block: int>>")
