"""Blocks of consecutive documents: as many bytes of text each, and no document id in two."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a missing id counts as: before every other.
NO_ID = -(1 << 63)


def sort_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def block_starts(docs: DataFrame, block_bytes: int) -> np.ndarray:
    """The first id of each block, ascending.

    Ids and text lengths are dealt out by id range; each range is cut where its texts reach
    ``block_bytes``. What comes to the driver is one number for ``block_bytes`` of text (and
    one for each range), eight bytes for millions.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, last = None, None
        for batch in batches:
            starts = []
            for i, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i != last and (filled is None or filled + size > block_bytes):
                    starts.append(i)
                    filled = 0
                filled, last = filled + size, i
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64())], ["start"])

    sizes = docs.select(sort_id().alias("i"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = (sizes.repartitionByRange(width, "i").sortWithinPartitions("i")
              .mapInArrow(cut, "start long").collect())
    return np.array(sorted(r["start"] for r in starts), dtype=np.int64)


def block_of(starts: np.ndarray) -> Callable[..., Column]:
    """A column function: the number of the block that an id belongs to."""
    @F.pandas_udf("int")
    def block(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy(), side="right") - 1)
    return block
