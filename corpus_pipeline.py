"""The training-data pipeline: documents in, the mix to train on out.

Each stage reads what the stage before it wrote and works on all of it:

1. toxicity: documents scored 0.5 or more go;
2. line dedup: lines that an earlier document or line holds go, and documents left without any
   line that had some; ``n_chars`` follows the text;
3. n-gram Jaccard join: of each group of near duplicates the document with the least id stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. mixing: documents that the mix takes words of, with ``size``, ``source_size``, ``target``,
   ``epochs`` and ``taken``; documents marked as good weigh more.

All stages but the last return the columns of their input, whatever else these are named.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebind.llm import toxicity
from casebind.llm.decontaminate import decontaminate
from casebind.llm.line_dedup import dedup_lines
from casebind.llm.mixing import mix, quality_weights
from casebind.llm.ngram_join import one_of_each
from casebind.sources.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _beside(docs: DataFrame, added: Iterable[str],
            run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` on ``docs``, whose own columns keep their names and values though it adds some."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in set(added)}
    out = run(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return _beside(docs, ("score", "predicted"),
                   lambda d: toxicity.score(d, model).where("predicted = 0"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def run(d: DataFrame) -> DataFrame:
        out = dedup_lines(d).where("n_lines = 0 OR n_kept > 0")
        if "n_chars" in d.columns:
            kind = dict(d.dtypes)["n_chars"]
            out = out.withColumn("n_chars", F.length("text").cast(kind))
        return out
    return _beside(docs, ("n_lines", "n_kept"), run)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def draw_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, quality_weights(_table(spark, sf_dir, "labels"))).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", draw_mix),
]

#: Toxicity scores come from a fitted model, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
