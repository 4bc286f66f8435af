"""Document fingerprints: threshold-scaled sketches of word shingles, and likeness of two.

A sketch keeps every shingle hash below a fixed fraction (1 / ``SCALE``) of the hash range, the same
for all texts, so sketches of any two, however unequal, sample the same shingles: the shared hashes
estimate resemblance and containment, and the union of two sketches is the sketch of both texts.

A text none of whose hashes is that small (about one of 300 with 24 words) notes its least hash in
their stead. Two such texts are alike if these are equal, which estimates resemblance with one
sample; of their containment in others there is no estimate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebind.llm.arrays import SPACED, bounds, shingles, words
from casebind.llm.blocks import NO_ID, block_of, block_starts, sort_id

SHINGLE, SCALE = 5, 4
_LIMIT = np.uint64((1 << 64) // SCALE)


class Sketch:
    """The hashes below the limit, ascending, or the least one of a text that has none of these."""

    def __init__(self, hashes: np.ndarray):
        self.kept, self.least = hashes[:np.searchsorted(hashes, _LIMIT)], hashes[:1]

    @classmethod
    def read(cls, text: str) -> Sketch:
        return cls(np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64))

    @property
    def hashes(self) -> np.ndarray:
        return self.kept if len(self.kept) else self.least

    def __str__(self) -> str:
        return self.hashes.astype(">u8").tobytes().hex()

    def merged(self, other: Sketch) -> Sketch:
        """The sketch of the union of the shingles."""
        return Sketch(np.union1d(self.hashes, other.hashes))

    def _shared(self, other: Sketch) -> int:
        return len(np.intersect1d(self.kept, other.kept, assume_unique=True))

    def likeness(self, other: Sketch) -> float:
        """Estimated resemblance (Jaccard) of the shingle sets, 0 to 1; 1 for two empty texts."""
        total = len(self.kept) + len(other.kept)
        if not total:
            return float(np.array_equal(self.least, other.least))
        both = self._shared(other)
        return both / (total - both)

    def containment(self, other: Sketch) -> float | None:
        """Estimated share of this text's shingles that the other has; None where the sketch has
        none to tell by."""
        return self._shared(other) / len(self.kept) if len(self.kept) else None


def sketches(texts: pa.Array | list[str | None]) -> list[Sketch]:
    w = words(texts if isinstance(texts, (pa.Array, pa.ChunkedArray))
              else pa.array(texts, pa.large_string()), SPACED)
    h, doc = shingles(w, SHINGLE)
    at = bounds(doc, len(w.first) - 1)
    return [Sketch(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def fingerprints(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint`` (replaced if there): the sketch of ``column``.

    A null text counts as empty; empty texts share the empty sketch. No shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name != "fingerprint"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([str(s) for s in sketches(batch.column(column))], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), made],
                                             [*(f.name for f in kept), "fingerprint"])

    schema = T.StructType([*kept, T.StructField("fingerprint", T.StringType())])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(add, schema)


def compared(docs: DataFrame, block_bytes: int = 8 << 20) -> DataFrame:
    """Fingerprints of texts, of edited texts, and their likeness to the next document.

    The edited text is the text with its last half (rounded down, in code points) replaced by as
    many first code points of the next document by doc_id (all, if it has fewer; after the last
    comes the first). Rows with equal ids follow each other by text; rows without an id come
    first. Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next. A single row is its own next.

    Text is shuffled once, by block of consecutive ids; a block also gets the first document of
    the next one, which the driver knows from the block starts.
    """
    starts = block_starts(docs, block_bytes)
    last = len(starts) - 1

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(starts, ids.to_numpy(), side="right") - 1
        first = np.isin(ids.to_numpy(), starts)
        return pd.Series([[b, (b - 1) % (last + 1)] if f and last else [b]
                          for b, f in zip(own.tolist(), first.tolist(), strict=True)])

    own = block_of(starts)
    rows = (docs.select(sort_id().alias("i"), F.coalesce(
        F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumn("own", own("i")).withColumn("block", F.explode(places("i"))))

    def run(table: pa.Table) -> pa.Table:
        here = table.filter(pa.compute.equal(table["own"], table["block"])) \
            .sort_by([("i", "ascending"), ("text", "ascending")])
        ahead = table.filter(pa.compute.not_equal(table["own"], table["block"])) \
            .sort_by([("text", "ascending")])
        texts = [t or "" for t in here["text"].to_pylist()]
        follow = (ahead if ahead.num_rows else here).slice(0, 1)["text"].to_pylist()
        follow = [*texts[1:], *(t or "" for t in follow)]
        ids = here["i"].to_pylist()
        out = {k: [] for k in ("edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
        step = 512
        for a in range(0, len(texts), step):
            mine, nexts = texts[a:a + step], follow[a:a + step]
            edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2]
                      for t, n in zip(mine, nexts, strict=True)]
            found = sketches([*mine, *nexts[-1:]])
            for s, e, n in zip(found[:-1], sketches(edited), found[1:], strict=True):
                out["fingerprint"].append(str(s))
                out["edited_fingerprint"].append(str(e))
                out["near_edited"].append(s.likeness(e))
                out["near_next"].append(s.likeness(n))
            out["edited"] += edited
        return pa.table({"doc_id": pa.array([None if i == NO_ID else i for i in ids], pa.int64()),
                         "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                         **{k: pa.array(v, pa.float64() if k.startswith("near") else pa.string())
                            for k, v in out.items()}})

    return rows.groupBy("block").applyInArrow(
        run, "doc_id long, n_chars long, edited string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
