"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is cut into complete epochs (every document once each) and a rest. For the
rest documents are drawn without replacement with probability growing with their quality weight:
each gets the key -ln(u) / weight, u being a hash of its id, and those with the smallest keys are
taken until their sizes reach the rest. The running sizes come from two levels: a source is cut
into buckets by key, so many that each holds a bounded number of documents; bucket sums give each
bucket's start, and only inside a bucket are documents sorted. A source with a third of all rows
is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebind.llm.aside import packed, unpacked

SOURCE_WEIGHTS = (3, 1, 2)
SHARE, MAX_EPOCHS = 1.5, 2
GOOD, POOR = 3.0, 1.0  # documents without a mark count as poor ones


def uniform(identity: Column) -> Column:
    """A number in (0, 1) from the hash of an id, the same in every run."""
    digits = F.substring(F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``weight``, a row per marked id: most of its marks say whether it is good."""
    return (labels.where("quality IS NOT NULL").groupBy("doc_id")
            .agg(F.when(F.avg("quality") > 0.5, GOOD).otherwise(POOR).alias("weight")))


def targets(sizes: DataFrame, weights: Sequence[int] = SOURCE_WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``.

    Sources take the weights in turn, by code point, null last. ``share`` of all sizes is dealt
    out by weight; a target stops at ``max_epochs`` times its source and the excess is dealt out
    again. That ends at target = least(cap, level * weight) with one level for all: with sources
    in the order of cap / weight, those before the level are at their cap. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = (sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
              .withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("w")))
    everything = Window.partitionBy()
    level = ((F.lit(share) * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))
                                       ).over(everything))
            .select("source", "source_size", F.coalesce(F.least(
                F.col("cap").cast("double"), F.col("level") * F.col("w")),
                F.col("cap").cast("double")).alias("target")))


def mix(docs: DataFrame, quality: DataFrame | None = None,
        weights: Sequence[int] = SOURCE_WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of ``docs``: its columns, size, source_size, target, epochs and taken.

    ``quality`` (doc_id and weight, a row per id) weighs documents within their source (none, null
    and values of 0 or less: 1; weights of 1 and more spread evenly over the buckets). It is
    joined after texts are counted, and by a shuffle at every size, as it grows with the
    documents. ``epochs`` is how often a document is in the
    mix, ``taken`` its words times that. The last document drawn is taken if that brings the
    source nearer to its target. Equal keys (repeated ids) are drawn in the order of id, size and
    a hash of the text. Empty texts have size 0; a source of size 0 has target 0 and nothing
    drawn. A null source is a source. Columns with the names of the new ones are replaced.
    """
    added = ("size", "source_size", "target", "epochs", "taken")
    names = [c for c in docs.columns if c not in added]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    used = ("doc_id", "text", "source")
    sized = packed(docs.select(*[f"`{c}`" for c in names]), *used).withColumns(
        {"size": word_count(F.col("text")), "text_hash": F.xxhash64("text")})
    weight = F.lit(1.0)
    if quality is not None:
        marks = quality.select(F.col("doc_id").alias("marked"), F.col("weight").cast("double").alias("mark"))
        sized = sized.join(marks.hint("merge"), F.col("doc_id") == F.col("marked"), "left").drop("marked")
        weight = F.when(F.col("mark") > 0, F.col("mark")).otherwise(1.0)
    sized = (sized
             .withColumns({"key": -F.ln(uniform(F.col("doc_id"))) / weight,
                           "name": F.when(F.col("source").isNull(), "")
                           .otherwise(F.concat(F.lit("="), F.col("source")))})
             # a growing function of the key that spreads a source over the shuffle
             .withColumn("bucket", F.floor(F.lit(width) * (1 - F.exp(-F.col("key")))).cast("int")))
    sums = sized.groupBy("name", "source", "bucket").agg(F.sum("size").alias("in_bucket"))
    of_sources = targets(sums.groupBy("source").agg(F.sum("in_bucket").alias("source_size")),
                         weights, share, max_epochs)
    starts = (sums.withColumn("start", F.sum("in_bucket").over(
        Window.partitionBy("name").orderBy("bucket")) - F.col("in_bucket"))
              .join(of_sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
              .select("name", "bucket", "start", "source_size", "target"))
    running = F.sum("size").over(
        Window.partitionBy("name", "bucket").orderBy("key", "doc_id", "size", "text_hash")
        .rowsBetween(Window.unboundedPreceding, 0))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    drawn = F.least(F.col("size"), F.greatest(F.lit(0), F.col("left") - F.col("end") + F.col("size")))
    return (sized.join(starts, ["name", "bucket"])
            .withColumn("end", F.col("start") + running)
            .withColumn("epochs", full.cast("long")).withColumn("left", left)
            .withColumn("taken", (F.col("epochs") * F.col("size") + drawn).cast("long"))
            .select(*unpacked(names, used), *added))
