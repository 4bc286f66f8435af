"""Cutting a plan at a written table in the shared checkpoint folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Told = Callable[[], dict]


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="casebind-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/casebind/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once, read many: later jobs start from the files and read only their columns."""
    path = staging_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(
        *[f"`{c}`" for c in df.columns])


def unstaged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Leave the plan whole, for a caller that needs one lazy frame."""
    return df


def counted(df: DataFrame, *metrics: Column) -> tuple[DataFrame, Told]:
    """``df`` that counts its rows (``rows``), and other aggregates, as it is computed.

    What the second result returns is there once the frame has been written: metrics travel with
    the tasks of that job, so they cost none of their own. It waits until then.
    """
    observation = Observation()
    seen = df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    return seen, lambda: observation.get


def staged_and_counted(df: DataFrame, stage: Callable[..., DataFrame], label: str,
                       *metrics: Column) -> tuple[DataFrame, Told]:
    """``stage(df, label)`` and its metrics: told by the write, or asked for if there was none."""
    seen, told = counted(df, *metrics)
    out = stage(seen, label)
    if out is not seen:
        return out, told
    return df, lambda: df.agg(F.count(F.lit(1)).alias("rows"), *metrics).first().asDict()
