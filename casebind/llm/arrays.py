"""Words and shingles of many texts at once, as numpy arrays over the bytes of an Arrow column.

These run inside Spark tasks. All hashes are the same on every machine and Python process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_C1, _C2, _C3 = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53), _U(0x9E3779B97F4A7C15)
_LONG_WORD = 256


def _classes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Words are what stands between white space.
SPACED = ~_classes((0x09, 0x0D), (0x20, 0x20))
#: Words are runs of ASCII letters and digits and of everything beyond ASCII.
ALPHANUMERIC = _classes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of each number over all bits."""
    h = (h ^ (h >> _U(33))) * _C1
    h = (h ^ (h >> _U(33))) * _C2
    return h ^ (h >> _U(33))


@dataclass
class Words:
    """The words of some texts: their bytes, where each lies, its hash, and where texts begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # of text i: first[i] to first[i + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts side by side and where each begins and ends; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks]) \
            if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(at):
        at = np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    length = end - start
    out = mixed(length.astype(np.uint64) + _C3)
    rest = np.arange(len(start))
    step = 0
    while len(rest):
        left = np.minimum(length[rest] - 8 * step, 8)
        rest, left = rest[left > 0], left[left > 0]
        if not len(rest):
            break
        if 8 * step >= _LONG_WORD:  # very long ones, each by itself
            for i in rest:
                digest = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest()
                out[i] = int.from_bytes(digest, "little")
            break
        part = eight[start[rest] + 8 * step]
        part = part & (np.full(len(left), ~_U(0)) >> (_U(64) - left.astype(np.uint64) * _U(8)))
        out[rest] = mixed(out[rest] * _C3 + part)
        step += 1
    return out


def words(texts: pa.Array | pa.ChunkedArray, kind: np.ndarray = SPACED,
          lower: bool = False) -> Words:
    data, at = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = kind[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = at[(at < len(data))]
    before[edges] = False
    if len(data):
        after[-1] = False
        after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, start, end, hashed(data, start, end), doc, first)


def windows(w: Words, n: int, factor: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and which of them lie in one text."""
    size = max(0, len(w.hash) - n + 1)
    h = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        h = h * _U(factor) + w.hash[j:j + size]
    return mixed(h), w.doc[:size] == w.doc[n - 1:n - 1 + size]


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``n``-word runs, and the text of each, by text and hash.

    A text with fewer than ``n`` words, but some, has one shingle: all its words.
    """
    h, whole = windows(w, n)
    h, doc = h[whole], w.doc[:len(whole)][whole]
    short = np.flatnonzero((w.counts() > 0) & (w.counts() < n))
    if len(short):
        few = np.zeros(len(short), dtype=np.uint64)
        for j in range(n - 1):
            has = w.counts()[short] > j
            few[has] = few[has] * _C3 + w.hash[w.first[short[has]] + j]
        h = np.concatenate([h, mixed(few ^ _C1)])
        doc = np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each of ``n`` texts begin, in an array sorted by text."""
    return np.searchsorted(doc, np.arange(n + 1))


def pieces(table: pa.Table | pa.RecordBatch, column: str,
           size: int = 4 << 20) -> Iterator[pa.Table | pa.RecordBatch]:
    """Row ranges whose texts come to about ``size`` bytes: what a task works on at a time."""
    at = text_bytes(table.column(column))[1]
    row, n = 0, table.num_rows
    while row < n:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        yield table.slice(row, stop - row)
        row = stop
