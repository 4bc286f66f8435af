"""Resampling documents towards a target distribution, by hashed word runs.

Features are all runs of one to three words, counted by bucket of their CRC. A bucket's gain is
the log ratio of its smoothed shares in the target texts and in the documents; a document's weight
is the sum over its features. Adding Gumbel noise from a hash of the id and taking the highest
scores draws without replacement with probability growing with the weight.

The buckets come from an Aho-Corasick automaton. Its dictionary are the distinct words of the texts
a task has at hand, each between its delimiters, so that a match is a whole word; each carries the
word's CRC and length. One scan emits the payloads in order, and the CRC of a run is composed of
neighbouring payloads: crc(a b) is crc(a), moved on by the length of b, xor crc(b). No run of words
is ever written out. Texts are scanned once; counting and weighing read the buckets this leaves. The dictionary never outgrows the texts at hand (about 4 MB); words over
``LONG`` bytes are told by a pattern instead, so that no automaton grows with one word.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebind.llm.arrays import ALPHANUMERIC, bounds, pieces, text_bytes
from casebind.llm.numbering import numbered
from casebind.sources.staging import staged

BUCKETS, RUN, SEED, MIN_WORDS, PERCENT = 10_000, 3, 42, 20, 5
LONG = 512

_CLEAN = np.where(ALPHANUMERIC, np.arange(256), 0x20).astype(np.uint8)
_CLEAN[0x41:0x5B] += 32
_LONG_WORD = re.compile(f"[^ ]{{{LONG + 1},}}")


def _shift_tables(count: int) -> list[np.ndarray]:
    """For k = 0, 1, ...: what each byte of a CRC becomes when 2**k zero bytes follow.

    Moving a CRC on is linear over its bits, so four tables of 256 values make one such step.
    """
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)

    def one(c: np.ndarray) -> np.ndarray:
        return byte[c & 255] ^ (c >> np.uint32(8))

    each = np.array([[b << (8 * j) for b in range(256)] for j in range(4)], dtype=np.uint32)
    tables = [one(each)]
    for _ in range(count - 1):
        tables.append(_through(tables[-1], tables[-1]))
    return tables


def _through(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = table[0][c & 255]
    for j in (1, 2, 3):
        out = out ^ table[j][(c >> np.uint32(8 * j)) & 255]
    return out


_SHIFTS = _shift_tables(32)
_SPACE = np.uint32(zlib.crc32(b" "))


def composed(crc: np.ndarray, follow: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC of two stretches side by side, from that of each and the length of the second."""
    crc, k = crc.copy(), 0
    while len(length) and int(length.max()) >> k:
        some = (length >> k) & 1 == 1
        crc[some] = _through(_SHIFTS[k], crc[some])
        k += 1
    return crc ^ follow


def payloads(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC and length of each word of the texts, in order, and the text it is in."""
    data, at = text_bytes(texts)
    n = len(at) - 1
    line = np.full(len(data) + n + 1, 0x20, np.uint8)
    line[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = _CLEAN[data]
    text = line.tobytes().decode("latin-1")  # a character for each byte
    words = ahocorasick.Automaton()
    for word in set(text.split(" ")):
        if 0 < len(word) <= LONG:
            words.add_word(f" {word} ", zlib.crc32(word.encode("latin-1")) << 32 | len(word))
    found = np.zeros(0, np.uint64)
    if len(words):
        words.make_automaton()
        found = np.fromiter(itertools.chain.from_iterable(words.iter(text)), np.uint64)
    end, payload = found[::2].astype(np.int64), found[1::2]
    long = [(m.end(), zlib.crc32(m[0].encode("latin-1")) << 32 | m.end() - m.start())
            for m in _LONG_WORD.finditer(text)]
    if long:
        end = np.append(end, np.array([e for e, _ in long], np.int64))
        payload = np.append(payload, np.array([p for _, p in long], np.uint64))
        order = np.argsort(end, kind="stable")
        end, payload = end[order], payload[order]
    doc = np.searchsorted(at + np.arange(n + 1), end, side="left") - 1
    return ((payload >> np.uint64(32)).astype(np.uint32),
            (payload & np.uint64(0xFFFFFFFF)).astype(np.int64), doc)


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature, and the number of words of each text."""
    word, length, doc = payloads(texts)
    crc, bucket, where = word, [word % buckets], [doc]
    for k in range(1, RUN):
        crc = composed(composed(crc[:-1], _SPACE, np.ones(max(len(crc) - 1, 0), np.int64)),
                       word[k:], length[k:])
        inside = doc[:len(crc)] == doc[k:]
        bucket.append(crc[inside] % buckets)
        where.append(doc[k:][inside])
    return (np.concatenate(bucket).astype(np.int64), np.concatenate(where),
            np.bincount(doc, minlength=len(texts)))


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def featured(docs: DataFrame, keep: Sequence[str] = (), buckets: int = BUCKETS, column: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_words and ``ids``: the bucket of every feature.

    No shuffle. Buckets take two bytes a feature, about what the text takes; written once they
    save a second scan.
    """
    own = [docs.schema[c] for c in keep]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{column}`").cast("string").alias("text"))
    fields = [*(T.StructField(f"k{i}", f.dataType) for i, f in enumerate(own)),
              T.StructField("n_words", T.LongType()), T.StructField("ids", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                bucket, doc, n_words = features(piece.column("text"), buckets)
                order = np.argsort(doc, kind="stable")
                data = bucket[order].astype(_width(buckets)).tobytes()
                at = bounds(doc[order], piece.num_rows) * _width(buckets).itemsize
                ids = pa.Array.from_buffers(pa.large_binary(), piece.num_rows, [
                    None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(i) for i in range(len(own))), pa.array(n_words, pa.int64()),
                     ids.cast(pa.binary())], [f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields)).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "ids")


def _ids(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all features of the rows, and how many each row has."""
    lists = batch.column("ids").to_pylist()
    width = _width(buckets)
    return np.frombuffer(b"".join(lists), width), np.array([len(x) // width.itemsize for x in lists], np.int64)


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``featured`` rows fall into each bucket. One number a bucket
    reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            n += np.bincount(_ids(batch, buckets)[0], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], ["bucket", "n"])

    told = (rows.select("ids").mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[told["bucket"].to_numpy()] = told["n"].to_numpy()
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / document share)) of each bucket, both counted one up."""
    m, s_all, t_all = len(docs), float(docs.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m))))
                     for s, t in zip(docs.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``featured`` rows with n_features and weight in place of their buckets. No shuffle."""
    own = [f for f in rows.schema.fields if f.name != "ids"]
    inside = [f"k{i}" for i in range(len(own))]
    fields = [*(T.StructField(k, f.dataType) for k, f in zip(inside, own, strict=True)),
              T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = _ids(batch, len(gain))
            total = np.append(0, np.cumsum(gain[ids]))
            end = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in inside), pa.array(n), pa.array(total[end] - total[end - n])],
                [f.name for f in fields])

    return (rows.select(*[F.col(f"`{f.name}`").alias(k) for k, f in zip(inside, own, strict=True)], "ids")
            .mapInArrow(run, T.StructType(fields))
            .select(*[F.col(k).alias(f.name) for k, f in zip(inside, own, strict=True)], "n_features", "weight"))


def resample(docs: DataFrame, target: DataFrame, keep: Sequence[str] | None = None,
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, column: str = "text") -> DataFrame:
    """A row per row of ``docs``: ``keep`` (all columns if None), n_words, n_features, weight, score, rank.

    ``score`` is the weight plus 1000 times Gumbel noise that ``seed`` and doc_id settle (a null
    id counts as empty text). Of the N rows with at least ``min_words`` words those with the
    floor(percent * N / 100) highest scores are drawn; ``rank`` is 1, 2, ... from the highest,
    equal scores by smaller doc_id (null first, then in any order), and null for all others.
    Null and empty texts have no words, no features and weight 0. Columns of the new names are
    replaced. An empty target makes rare buckets of the documents the likelier ones; empty
    ``docs`` give no rows.
    """
    added = ("n_words", "n_features", "weight", "score", "rank")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    carry = [*names, "doc_id"] if "doc_id" not in names else names
    rows = staged(featured(docs, carry, buckets, column), "features")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(featured(target, (), buckets, column), buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                    .cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed(rows, gain).withColumn("score", (F.col("weight") + noise).cast("long"))
    rows = staged(scored.withColumns({"_late": F.col("n_words") < min_words, "_down": -F.col("score")}), "scored")
    drawn = percent * rows.where("NOT _late").count() // 100
    return (numbered(rows, ["_late", "_down", "doc_id"], name="_place")
            .withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1))
            .select(*[f"`{c}`" for c in names], *added))
