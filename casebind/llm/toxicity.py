"""Toxicity scores that see through leetspeak, spacing and repetition.

A noisy channel: an obfuscated word is a lattice of what each character may stand for (itself, a
look-alike letter, one or two of a repeated letter, nothing for a separator). A Viterbi search
finds the restored word that a character language model and the channel like best. The model
mixes trigram counts over all documents with those of the marker words learned from the labels.
Texts are scored by the markers (words and word beginnings) in their plain and restored words.

Training reads at most ``max_rows`` labelled rows (those with the smallest id hashes); character
counts read all documents. What reaches the driver is bounded: one number per trigram of a fixed
alphabet, at most ``max_markers`` markers, and four numbers for each training row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebind.llm.arrays import ALPHANUMERIC, SPACED, Words, hashed, pieces, text_bytes, words
from casebind.sources.staging import staged

MAX_ROWS, MAX_MARKERS, MIN_TOXIC = 20_000, 4_000, 4
_HELD = 200_000  # features that a task counts before it hands them on
PREFIXES = (3, 4, 5, 6)

# What characters stand for in leetspeak.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~'"
_SWAPPED = 0.7  # channel cost of a look-alike, in nats
_DROPPED = 0.3  # of a separator or a repeated letter left out
_HALVED = 1.5  # of one letter of a pair left out
_KEPT = 3.0  # of a look-alike or separator that stands for itself inside a word

#: Classes of the character model: 0 word edge, 1-26 letters, 27 anything else.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x80:] = 27
_SIZE = 28


def _class(char: str) -> int:
    return int(_CLASS[ord(char)]) if ord(char) < 128 else 27


class CharacterModel:
    """Log probabilities of a character class after the two before it."""

    def __init__(self, corpus: np.ndarray, markers: list[str]):
        own = np.zeros(_SIZE ** 3)
        for word in markers:
            c = [0, 0, *map(_class, word), 0]
            for x, y, z in zip(c, c[1:], c[2:], strict=False):
                own[(x * _SIZE + y) * _SIZE + z] += 1
        self.log = np.log(0.5 * self._smooth(corpus) + 0.5 * self._smooth(own)).tolist()

    @staticmethod
    def _smooth(counts: np.ndarray) -> np.ndarray:
        three = counts.reshape(-1, _SIZE)
        two = three.reshape(_SIZE, _SIZE, _SIZE).sum(0)
        base = (two + 0.1) / (two + 0.1).sum(1, keepdims=True)
        back = np.tile(base, (_SIZE, 1))
        return ((three + 4 * back) / (three.sum(1, keepdims=True) + 4)).ravel()

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest path; ``lattice``: per place the strings it may stand for, with costs."""
        paths = {(0, 0): (0.0, "")}
        for options in lattice:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (x, y), (cost, text) in paths.items():
                for string, extra in options:
                    a, b, total = x, y, cost + extra
                    for char in string:
                        c = _class(char)
                        total -= self.log[(a * _SIZE + b) * _SIZE + c]
                        a, b = b, c
                    if (a, b) not in after or total < after[a, b][0]:
                        after[a, b] = (total, text + string)
            paths = after
        return min((cost - self.log[(x * _SIZE + y) * _SIZE], text)
                   for (x, y), (cost, text) in paths.items())[1]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    out = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        char, n = run.group(1), len(run.group(0))
        if char in LOOKALIKES:
            options = [(x, _SWAPPED + _HALVED * (n == 2)) for x in LOOKALIKES[char]]
            if n > 1:
                options += [(2 * x, _SWAPPED) for x in LOOKALIKES[char]]
            options.append((char, _KEPT))
        elif char in SEPARATORS:
            options = [("", _DROPPED), (char, _KEPT)]
        else:
            options = [(char, (0.0, 0.0, _HALVED)[n] if n < 3 else _DROPPED)]
            options += [(2 * char, _DROPPED * (n > 2))] * (n > 1)
        out.append(options)
    return out


# What stands around a word. A look-alike other than "!" at the end may also belong to the word.
_BEFORE = r"""^[\s"'()\[\]{}<>.,;:?#%&*~_^=/\\-]+"""
_AFTER = r"""[\s"')\[\]{}<>.,;:?!#%&*~_^=/\\-]+$"""
_STRIPPED = re.compile(rf"{_BEFORE}|{_AFTER}")
_SIGNS = re.compile(r"""[\s"'()\[\]{}<>.,;:?!#%&*~_^=/\\$|+-]+$""")
_CHANGED = np.zeros(128, dtype=bool)
_CHANGED[[ord(c) for c in [*LOOKALIKES, *SEPARATORS] if ord(c) < 128]] = True
_CHANGED_BEYOND = [ord(c) for c in LOOKALIKES if ord(c) > 127]
_LATTICE_CHANGES = re.compile(rf"(.)\1|[{re.escape(''.join(LOOKALIKES) + SEPARATORS)}]", re.S)


def readings(word: str) -> list[str]:
    """What of a word in lower case is decoded: without the punctuation around it, with and
    without the look-alikes at its end; only what ``lattice`` can change."""
    token = _STRIPPED.sub("", word)
    return [t for t in dict.fromkeys((token, _SIGNS.sub("", token))) if _LATTICE_CHANGES.search(t)]


def _suspects(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words in lower case ``lattice`` may change: any look-alike, separator or letter that
    stands twice; a cheap test that passes all that ``readings`` keeps."""
    characters = Characters(data)
    char = np.frombuffer(data.tobytes().decode("utf8").encode("utf-32-le"), dtype=np.uint32)
    strange = _CHANGED[np.minimum(char, 127)] & (char < 128) | np.isin(char, _CHANGED_BEYOND)
    twice = np.zeros(len(char), dtype=bool)
    twice[1:] = char[1:] == char[:-1]
    n_strange, n_twice = (np.concatenate([[0], np.cumsum(x)]) for x in (strange, twice))
    first, last = characters.before[start], characters.before[end]
    return (n_strange[last] > n_strange[first]) | (n_twice[last] > n_twice[np.minimum(first + 1, last)])


def restored(w: Words, odd: np.ndarray, single: np.ndarray, decode) -> list[set[str]]:
    """Per text the restored forms, as far as they differ, of its suspicious words and of runs of
    three or more one-letter words taken as one. Each distinct word is decided once."""
    out: list[set[str]] = [set() for _ in range(len(w.first) - 1)]
    raw = w.data
    at = np.flatnonzero(odd)
    _, example, kind = np.unique(w.hash[at], return_index=True, return_inverse=True)
    forms = []
    for i in at[example]:
        word = raw[w.start[i]:w.end[i]].tobytes().decode("utf8", "replace")
        forms.append([f for t in readings(word) if (f := decode(t)) != t])
    changed = np.array([bool(f) for f in forms], dtype=bool)
    hit = np.flatnonzero(changed[kind]) if len(at) else at
    for d, k in zip(w.doc[at[hit]].tolist(), kind[hit].tolist(), strict=True):
        out[d].update(forms[k])
    at = np.flatnonzero(single)
    if len(at) > 2:
        for group in np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(w.doc[at]) > 0)) + 1):
            if len(group) > 2:
                letters = raw[w.start[group[0]]:w.end[group[-1]]].tobytes().decode("utf8", "replace")
                out[w.doc[group[0]]].add(decode(re.sub(r"\s+", "", letters)))
    return out


def _singles(w) -> np.ndarray:
    """One-character words that are a letter or stand for one."""
    at = w.data[w.start] if len(w.start) else np.zeros(0, dtype=np.uint8)
    ok = (_CLASS > 0) & (np.arange(256) < 128)
    ok[[ord(c) for c in "013457@$!|+"]] = True
    return (w.end - w.start == 1) & ok[at]


_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def features(words_: set[str]) -> set[str]:
    """Words and their beginnings; a beginning ends in ``*``."""
    out = set(words_)
    for word in words_:
        for n in PREFIXES:
            if len(word) > n:
                out.add(word[:n] + "*")
    return out


def lowered(texts: pa.Array | pa.ChunkedArray) -> pa.Array | pa.ChunkedArray:
    """Texts in lower case, alike in training and scoring; bytes that are not UTF-8 are replaced."""
    try:
        return pa.compute.utf8_lower(texts)
    except pa.ArrowInvalid:
        return pa.compute.utf8_lower(pa.array(
            [t if t is None else t.decode("utf8", "replace") for t in texts.cast(pa.large_binary()).to_pylist()],
            pa.large_string()))


class Characters:
    """Where the characters of some UTF-8 bytes begin."""

    def __init__(self, data: np.ndarray):
        first = (data & 0xC0) != 0x80
        self.at = np.concatenate([np.flatnonzero(first), [len(data)]])
        self.before = np.concatenate([[0], np.cumsum(first)])

    def beginnings(self, w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of more than ``n`` characters, and where the first ``n`` of each end."""
        rows = np.flatnonzero(self.before[w.end] - self.before[w.start] > n)
        return rows, self.at[self.before[w.start[rows]] + n]


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of character classes over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE ** 3, dtype=np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                data, at = text_bytes(part.column("text"))
                c = np.concatenate([[0], _CLASS[data], [0]])
                c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # one edge in a row
                total += np.bincount((c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:],
                                     minlength=_SIZE ** 3) if len(c) > 2 else 0
                # word beginnings: the edge counts as two
                begin = np.flatnonzero((c[:-1] == 0) & (c[1:] != 0))
                total += np.bincount(c[begin + 1], minlength=_SIZE ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                                         ["trigram", "n"])

    rows = (docs.select("text").mapInArrow(count, "trigram int, n long")
            .groupBy("trigram").agg(F.sum("n").alias("n")).collect())  # at most 28 ** 3 numbers
    out = np.zeros(_SIZE ** 3)
    for r in rows:
        out[r["trigram"]] = r["n"]
    return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id's digits divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass
class Model:
    """What scoring needs, a few hundred kilobytes at most."""

    characters: np.ndarray
    markers: dict[str, float]
    weights: np.ndarray

    def decoder(self):
        model = CharacterModel(self.characters, [m.rstrip("*") for m in self.markers])
        known: dict[str, str] = {}

        def decode(token: str) -> str:
            if token not in known:
                if len(known) > 50_000:
                    known.clear()
                known[token] = model.decode(lattice(token))
            return known[token]
        return decode

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of marker words and of marker beginnings, with weights."""
        out = []
        for begins in (False, True):
            names = sorted(m for m in self.markers if m.endswith("*") == begins)
            raw, at = text_bytes(pa.array([m.rstrip("*") for m in names], pa.large_string()))
            h = hashed(raw, at[:-1], at[1:])
            order = np.argsort(h)
            out += [h[order], np.array([self.markers[m] for m in names])[order]]
        return tuple(out)


def _evidence(texts: pa.Array, model: Model, decode, lookup) -> np.ndarray:
    """Per text: largest marker weight, sum of the distinct markers' weights, their number."""
    texts = lowered(texts)
    w = words(texts, ALPHANUMERIC)
    n = len(w.first) - 1
    spaced = words(texts, SPACED)
    odd, single = _suspects(spaced.data, spaced.start, spaced.end), _singles(spaced)
    fixed = restored(spaced, odd, single, decode)
    extra = words(pa.array([" ".join(f) for f in fixed], pa.large_string()), ALPHANUMERIC)
    whole, whole_weight, begin, begin_weight = lookup
    doc, key, weight = [], [], []
    for v in (w, extra):
        characters = Characters(v.data)
        for table, weights, cuts in ((whole, whole_weight, (None,)), (begin, begin_weight, PREFIXES)):
            if not len(table):
                continue
            for cut in cuts:
                if cut is None:
                    rows, h = np.arange(len(v.start)), v.hash
                else:
                    rows, stop = characters.beginnings(v, cut)
                    h = hashed(v.data, v.start[rows], stop)
                spot = np.minimum(np.searchsorted(table, h), len(table) - 1)
                hit = np.flatnonzero(table[spot] == h)
                doc.append(v.doc[rows[hit]])
                key.append(h[hit])
                weight.append(weights[spot[hit]])
    out = np.zeros((n, 3))
    if doc:
        doc, key, weight = map(np.concatenate, (doc, key, weight))
        order = np.lexsort((key, doc))
        doc, key, weight = doc[order], key[order], weight[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        doc, weight = doc[new], weight[new]
        np.maximum.at(out[:, 0], doc, weight)
        np.add.at(out[:, 1], doc, weight)
        np.add.at(out[:, 2], doc, 1)
    return out


def _design(evidence: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(evidence)), evidence[:, 0], np.log1p(evidence[:, 1]),
                            np.log1p(evidence[:, 2])])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
          max_markers: int = MAX_MARKERS) -> Model:
    """Markers from the training rows, calibrated by their evidence on rows they did not come from.

    A document with several labels is toxic if most of them say so. Rows of ``held_out`` and
    null labels are not learned from; without toxic training rows every score is the prior.
    """
    chosen = (labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.avg(F.col("toxic").cast("double")).alias("t"))
              .select("doc_id", (F.col("t") > 0.5).cast("int").alias("toxic"),
                      F.xxhash64("doc_id", F.lit(6)).alias("h"))
              .orderBy("h").limit(max_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows at most
    characters = character_counts(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        total: dict[str, list[int]] = {}

        def emitted() -> pa.RecordBatch:
            columns = zip(*total.values(), strict=True) if total else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), *(pa.array(list(c), pa.int64()) for c in columns)],
                ["f", "clean0", "toxic0", "clean1", "toxic1"])

        for batch in batches:
            for text, toxic, h in zip(lowered(batch.column("text")).to_pylist(),
                                      *(batch.column(c).to_pylist() for c in ("toxic", "h")),
                                      strict=True):
                if hash(text) in seen:  # copies count once
                    continue
                seen.add(hash(text))
                for f in {"", *features(set(_WORD.findall(text or "")))}:
                    total.setdefault(f, [0, 0, 0, 0])[2 * (h % 2) + toxic] += 1
                if len(total) > _HELD:
                    yield emitted()
                    total.clear()
        yield emitted()

    counts = (sample.mapInArrow(count, "f string, clean0 long, toxic0 long, clean1 long, toxic1 long")
              .groupBy("f").agg(*(F.sum(c).alias(c) for c in ("clean0", "toxic0", "clean1", "toxic1")))
              .where((F.col("f") == "") | (F.col("toxic0") + F.col("toxic1") >= 3)))
    counts = staged(counts, "toxic-features")
    sizes = counts.where(F.col("f") == "").first()
    if not sizes or not sizes["toxic0"] + sizes["toxic1"] or not sizes["clean0"] + sizes["clean1"]:
        toxic, clean = (sizes["toxic0"] + sizes["toxic1"], sizes["clean0"] + sizes["clean1"]) \
            if sizes else (0, 0)
        return Model(characters, {}, np.array([math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0, 0.0]))

    def markers(*folds: int) -> dict[str, float]:
        clean, toxic = (reduce(Column.__add__, [F.col(f"{c}{k}") for k in folds])
                        for c in ("clean", "toxic"))
        n_clean, n_toxic = (sum(sizes[f"{c}{k}"] for k in folds) for c in ("clean", "toxic"))
        weight = F.ln((toxic + 0.1) / (n_toxic + 0.2)) - F.ln((clean + 0.1) / (n_clean + 0.2))
        found = (counts.where((F.col("f") != "") & (toxic >= MIN_TOXIC))
                 .select("f", weight.alias("w"), (toxic * weight).alias("gain")).where(F.col("w") > 3)
                 .orderBy(F.desc("gain"), "f").limit(max_markers).collect())
        return {r["f"]: r["w"] for r in found}

    # calibration by evidence from markers that the other half of the rows gave
    halves = [Model(characters, markers(1 - k), np.zeros(4)) for k in (0, 1)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = [(m, m.decoder(), m.table()) for m in halves]
        for batch in batches:
            fold = pa.compute.bit_wise_and(batch.column("h"), 1)
            for k, (model, decode, lookup) in enumerate(tools):
                half = batch.filter(pa.compute.equal(fold, k))
                for part in pieces(half, "text"):
                    e = _evidence(part.column("text"), model, decode, lookup)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("toxic").cast(pa.int32()), *(pa.array(e[:, k]) for k in range(3))],
                        ["toxic", "a", "b", "c"])

    rows = sample.mapInArrow(measure, "toxic int, a double, b double, c double").collect()
    data = np.array([[r["a"], r["b"], r["c"], r["toxic"]] for r in rows]).reshape(-1, 4)
    return Model(characters, markers(0, 1), _logistic(_design(data[:, :3]), data[:, 3]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), replaced if there.

    A null text counts as empty. One pass over whole texts, no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode, lookup = model.decoder(), model.table()
        for batch in batches:
            for part in pieces(batch, "text"):
                e = _design(_evidence(part.column("text"), model, decode, lookup))
                p = 1 / (1 + np.exp(-np.clip(e @ model.weights, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.array(p),
                     pa.array((p >= 0.5).astype(np.int32))],
                    [*(f.name for f in kept), "score", "predicted"])

    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
