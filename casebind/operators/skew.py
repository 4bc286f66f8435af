"""Joins that keep their balance when one key holds a large share of the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SKETCH_LIMIT = 1_000_000  # items that the sketch function can follow
_SALT, _HOT_KEY, _FAN = "_salt", "_hot_key", "_fan"

HotKeys = list[tuple[int, int]]


def _key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in on])


def _shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, on: Sequence[str]) -> HotKeys:
    """Hashes of the keys that overfill a shuffle partition, and how many each should fill.

    One scan of the key columns with a mergeable frequent-items sketch: no shuffle of rows.
    No more keys than the shuffle has partitions can overfill one, so that many numbers come back
    at most. The estimate only decides how rows are spread, never which rows join.
    """
    width = _shuffle_width(df)
    items = min(width, _SKETCH_LIMIT // 20)
    row = (
        df.select(_key_hash(on).alias("h"),
                  reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on]).alias("no_key"))
        .agg(F.count("*").alias("n"),
             F.expr(f"approx_top_k(h, {items}, {20 * items}) FILTER (WHERE NOT no_key)")
             .alias("top"))
        .first()
    )
    shares = [(t["item"], -(-t["count"] * width // row["n"])) for t in row["top"] or []]
    return [(item, fan) for item, fan in shares if fan > 1]


def same_types(a: DataFrame, b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their keys in the type that an equality of the two compares in.

    Equal values of different types have different hashes, so keys must agree before hashing.
    """
    wide = a.select(*on).limit(0).union(b.select(*on).limit(0)).schema
    return tuple(
        df.withColumns({f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in wide.fields
                        if df.schema[f.name].dataType != f.dataType}) for df in (a, b))


def _fanned(df: DataFrame, on: Sequence[str], hot: HotKeys) -> DataFrame:
    """With the fan of its key, null where the key is not hot."""
    rows = ",".join(f"({item}L,{fan})" for item, fan in hot)
    # no more literal rows than the shuffle has partitions
    table = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t({_HOT_KEY}, {_FAN})")
    return (df.withColumn(_HOT_KEY, _key_hash(on))
            .join(F.broadcast(table), _HOT_KEY, "left").drop(_HOT_KEY))


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
                hot: HotKeys | None = None, hint: str | None = None,
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Join many ``facts`` rows to few ``lookup`` rows per key, with hot keys spread out.

    ``how`` is any join that keeps or drops *facts* rows (``left``, ``inner``, ``left_semi``,
    ``left_anti``). Each hot key is cut into as many salts as partitions it would fill, and only
    its lookup rows are repeated; rows with a null key match nothing and are spread as well. The
    salt depends on the row and its input partition alone, so a task that is run again after a
    lost executor makes the same one. Without hot or null keys this is a plain join.

    Keys of unequal types are compared, and returned, in their common type; ``hot`` then must
    come from facts whose keys have it, and is looked for anew if they have not. ``hint`` is the
    join strategy for the lookup, where its size is known. ``spread_by`` names the columns whose
    hash deals out rows besides their input partition (all): what comes from a shuffle has to bring
    them along, even where nobody else reads them.
    """
    given = [facts.schema[c].dataType for c in on]
    facts, lookup = same_types(facts, lookup, on)
    if hot is None or given != [facts.schema[c].dataType for c in on]:
        hot = hot_keys(facts, on)
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    keeps_null_keys = how in ("left", "left_outer", "left_anti", "anti")
    if not hot and not keeps_null_keys:
        return facts.join(lookup.hint(hint) if hint else lookup, list(on), how)

    hashed = [F.col(f"`{c}`") for c, kind in facts.dtypes if not re.search("variant|map<", kind)
              and (spread_by is None or c in spread_by)]
    spread = F.xxhash64(F.spark_partition_id(), *hashed)
    width = F.lit(_shuffle_width(facts))
    columns = [f"`{c}`" for c in facts.columns]
    if hot:
        facts = _fanned(facts, on, hot)
        lookup = _fanned(lookup, on, hot).withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_FAN), F.lit(1)) - 1))
        ).drop(_FAN)
        fan = F.coalesce(F.col(_FAN), F.lit(1))
    else:
        lookup = lookup.withColumn(_SALT, F.lit(0))
        fan = F.lit(1)
    if keeps_null_keys:
        fan = F.when(null_key, width).otherwise(fan)
    salt = F.when(fan > 1, F.pmod(spread, fan)).otherwise(0).cast("int")
    salted = facts.withColumn(_SALT, salt).select(*columns, _SALT)
    return salted.join(lookup.hint(hint) if hint else lookup, [*on, _SALT], how).drop(_SALT)


def outer_join_many(keys: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Left outer join of ``keys`` to ``facts`` that may have many rows a key, hot ones spread out.

    The rows of a hot key are dealt to salts by a hash of the row. Which of its salts hold rows is
    counted for the hot keys alone (no more than two numbers for each partition of the shuffle),
    and the key is repeated for exactly those: every copy of it meets a row, so that a key without
    any is told in the same shuffle, without a second look at ``facts``. Null keys meet nothing
    and are spread as well.
    """
    facts, keys = same_types(facts, keys, [on])
    own, rest = [f"`{c}`" for c in keys.columns], [f"`{c}`" for c in facts.columns]
    width, salts = F.lit(_shuffle_width(keys)), F.array(F.lit(0))
    hot = hot_keys(facts, [on])
    if hot:
        salt = F.pmod(F.xxhash64(*rest), F.coalesce(F.col(_FAN), F.lit(1))).cast("int")
        facts = _fanned(facts, [on], hot).withColumn(_SALT, salt)
        held = (facts.filter(F.col(_FAN).isNotNull() & F.col(on).isNotNull())
                .groupBy(on).agg(F.collect_set(_SALT).alias(_FAN)).collect())
        copies = keys.sparkSession.createDataFrame(held, keys.select(on).schema.add(_FAN, T.ArrayType(T.IntegerType())))
        facts, keys = facts.select(*rest, _SALT), keys.join(F.broadcast(copies), on, "left")
        salts = F.coalesce(F.col(_FAN), salts)
    else:
        facts = facts.withColumn(_SALT, F.lit(0))
    alone = F.array(F.pmod(F.xxhash64(*own), width).cast("int"))
    keys = keys.select(*own, F.explode(F.when(F.col(on).isNull(), alone).otherwise(salts)).alias(_SALT))
    return keys.join(facts, [on, _SALT], "left").drop(_SALT)
