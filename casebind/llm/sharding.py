"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard bids for every record: from a hash of key and shard number comes u in (0, 1), the bid
is weight / -ln(u), and the greatest bid takes the record (equal bids: the lower shard). A shard's
share is its weight's share. One more shard only adds a bid, so records move into it and nowhere
else; a shard that goes only gives its own records away. Which shard a record is in depends on its
key and the weights alone, so this is a column: no shuffle, no table of shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind.llm.mixing import uniform
from casebind.llm.numbering import numbered

SHARDS = (1.0,) * 8
LAW = "key"


def shard_of(key: Column, weights: Sequence[float] = SHARDS) -> Column:
    """The shard, counted from 0, that takes ``key``; a null key is the empty one.

    Shards of weight 0 take nothing; one weight at least must be above 0.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    bids = [F.struct((F.lit(float(w)) / -F.ln(uniform(F.concat(text, F.lit(f":{i}"))))).alias("bid"),
                     F.lit(-i).alias("i")) for i, w in enumerate(weights) if w > 0]
    return (-F.array_max(F.array(*bids))["i"]).cast("int")


def assign_shards(docs: DataFrame, weights: Sequence[float] = SHARDS, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` (replaced if there). Rows of one key share a shard; all else passes."""
    return docs.withColumn("shard", shard_of(F.col(f"`{key}`"), weights))


def moved(docs: DataFrame, before: Sequence[float], after: Sequence[float],
          key: str = "doc_id") -> DataFrame:
    """The rows that change their shard when the weights change, with ``shard`` and ``from_shard``."""
    own = F.col(f"`{key}`")
    return (docs.withColumns({"from_shard": shard_of(own, before), "shard": shard_of(own, after)})
            .where("from_shard <> shard"))


def manifest(docs: DataFrame, weights: Sequence[float] = SHARDS) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot and grown_shard.

    ``size`` is the text's bytes in UTF-8 plus 1 (a null text has none), ``slot`` counts the rows
    of a shard from 0 by doc_id (null first), size and checksum, ``grown_shard`` is the shard
    after one of weight 1 is added. Rows with one id, or without any, follow the law into one
    shard, but their slots are dealt out over all tasks. Repeated rows have a slot each. Other
    columns are not used. Texts are not shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit(LAW).alias("law"),
                       shard_of(F.col("doc_id"), weights).alias("shard"),
                       shard_of(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"))
    return (numbered(rows, ["doc_id", "size", "text_crc32"], ["shard"], "slot")
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = SHARDS) -> None:
    """Write ``docs`` as Parquet below ``path``, a folder ``shard=N`` for each shard that has rows.

    Each task writes to the shards that its rows belong to, so texts are not shuffled and no
    shard goes through one task.
    """
    assign_shards(docs, weights).write.partitionBy("shard").parquet(path)
