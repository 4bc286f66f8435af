"""Line de-duplication by a deletion-neighbourhood join, in built-in Spark functions only.

Two lines are near if they differ by at most one edit (a character inserted, left out or
replaced); lines below ``MIN_LENGTH`` characters must be equal. A line goes if an equal or near
line stands earlier in the corpus, by document id and line number; the earliest stays. A line's
place also has a hash of its text, so that rows that share an id, or lack one, stay apart. Lines are
judged on the input, so a line goes even if the earlier one it is near to goes too. Empty lines
stay.

Equal lines are first reduced to their earliest place. Each distinct line then emits hashed keys
of its variants with one character deleted, equal keys meet, and the edit distance of what meets
is verified. Two facts keep the keys few without losing a pair:

* One edit leaves the first or the second half untouched. A line has partners only among lines of
  its length or one more or less that share a half, which a count per half shows; all others
  emit nothing. Those with partners vary only the other half, keyed by the shared one.
* Lines of equal length that agree after deleting the same place are all near each other, so each
  is compared with the earliest of them; lines one shorter meet the full line they extend. No
  pairs within a group are listed.

At scale: a line that is everywhere is one row a task after map-side combining; what is shuffled
besides are hashes and places. Text is shuffled by document, at every size in the same way, so
that one exchange serves all joins with it if only ids and texts are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebind.llm.aside import packed, unpacked
from casebind.sources.staging import staged

MIN_LENGTH = 10


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _halves(line: Column, n: Column) -> list[tuple[Column, Column]]:
    """Per way to halve a line of ``n`` characters: the key of the shared part, and the rest.

    The third serves lines one shorter, which are halved elsewhere.
    """
    m = F.floor(n / 2).cast("int")
    odd = n % 2 == 1
    head, tail = F.xxhash64(F.lit("head"), F.left(line, m)), F.xxhash64(F.lit("tail"), F.substring(line, m + 1, n))
    other = F.when(odd, F.xxhash64(F.lit("tail"), F.substring(line, m + 2, n))).otherwise(
        F.xxhash64(F.lit("head"), F.left(line, m - 1)))
    return [(head, F.substring(line, m + 1, n)), (tail, F.left(line, m)),
            (other, F.when(odd, F.left(line, m + 1)).otherwise(F.substring(line, m, n)))]


def _distinct_lines(docs: DataFrame) -> DataFrame:
    """Every distinct line that is not empty: two hashes, earliest place, length, half keys."""
    n = F.length("line")
    keys = F.when(n >= MIN_LENGTH, F.array(*(key for key, _ in _halves(F.col("line"), n))))
    return (docs.select("doc_id", "_text_hash", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .where("line <> ''")
            .select(F.xxhash64("line").alias("h"), F.hash("line").alias("g"), "doc_id", "pos", "_text_hash",
                    n.alias("n"), keys.alias("keys"))
            .groupBy("h", "g").agg(F.min(F.struct(F.col("doc_id").alias("id"), "pos", F.col("_text_hash").alias("text")))
                                   .alias("place"),
                                   F.first("n").alias("n"), F.first("keys").alias("keys")))


def _candidates(lines: DataFrame) -> DataFrame:
    """(place, n, way, key, alike, longer, shorter) of lines that share a half with a line of
    equal length (alike), one more (longer) or one less (shorter)."""
    halves = (lines.where("keys IS NOT NULL")
              .select("h", "place", "n", F.posexplode("keys").alias("way", "key")))
    by_length = Window.partitionBy("key").orderBy("n")
    shared = (halves.groupBy("key", "n").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
              .select("key", "n", (F.col("lo") < F.col("hi")).alias("alike"),
                      F.coalesce(F.lead("n").over(by_length) == F.col("n") + 1, F.lit(False)).alias("longer"),
                      F.coalesce(F.lag("n").over(by_length) == F.col("n") - 1, F.lit(False)).alias("shorter"))
              .where("alike OR longer OR shorter"))
    return halves.join(shared, ["key", "n"]).drop("h")


def _variants(lines: DataFrame) -> DataFrame:
    """(variant, full, place): hashed keys of the rest of each candidate with one deletion."""
    rest, n = F.col("rest"), F.col("n")
    places = F.when(F.length(rest) > 0, F.sequence(F.lit(1), F.length(rest))).otherwise(
        F.array().cast("array<int>"))

    def without(i: Column) -> Column:
        return F.concat(F.left(rest, i - 1), F.substring(rest, i + 1, F.length(rest)))

    none = F.array().cast("array<bigint>")
    replaced = F.when(F.col("alike"), F.transform(places, lambda i: F.xxhash64(
        "key", n, i, without(i)))).otherwise(none)
    shortened = F.when(F.col("shorter"), F.array_distinct(F.transform(places, lambda i: F.xxhash64(
        "key", n - 1, F.lit(0), without(i))))).otherwise(none)
    full = F.when(F.col("longer"), F.array(F.xxhash64("key", n, F.lit(0), rest))).otherwise(none)
    return lines.select("place", F.inline(F.concat(
        F.transform(F.concat(replaced, shortened), lambda v: F.struct(
            v.alias("variant"), F.lit(False).alias("full"))),
        F.transform(full, lambda v: F.struct(v.alias("variant"), F.lit(True).alias("full"))))))


def _near_pairs(variants: DataFrame) -> DataFrame:
    """(place, earlier): lines whose variants equal those of an earlier one.

    A variant with a full line ties the others to that line; one without ties all to the
    earliest. The group is as large as the alphabet times the length at most.
    """
    group = Window.partitionBy("variant")
    found = (variants.withColumn("least", F.min("place").over(group))
             .withColumn("whole", F.min(F.when(F.col("full"), F.col("place"))).over(group)))
    earlier = F.when(F.col("whole").isNull() | F.col("full"), F.col("least")).otherwise(F.col("whole"))
    return (found.select("place", earlier.alias("earlier")).where("earlier < place").distinct())


def _by_row(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` with what ``lists`` has for their id and text; a null id meets a null one."""
    same = docs["doc_id"].eqNullSafe(lists["_id"]) & (docs["_text_hash"] == lists["_text"])
    return docs.join(lists.hint("merge"), same, how).drop("_id", "_text")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, and n_lines and n_kept (without empty
    lines; columns of these names are replaced).

    A null text has one empty line and becomes ''. Rows without an id come first. Lines with one
    number in different rows of one id (or without any) are neither earlier than the other: the one
    with the lower text hash stays if they are equal, both if they are near. Rows of one id and
    text are the same row: what stays in one stays in all of them.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_kept")]
    docs = packed(docs.select(*[f"`{c}`" for c in names]), "doc_id", "text").withColumn(
        "_text_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    texts = docs.select("doc_id", "text", "_text_hash")
    lines = staged(_distinct_lines(texts), "lines")
    candidates = staged(_candidates(lines), "line-candidates")
    wanted = candidates.groupBy(F.col("place.id").alias("_id"), F.col("place.text").alias("_text")).agg(
        F.collect_list(F.struct(F.col("place.pos").alias("pos"), "n", "way", "key", "alike", "longer", "shorter")).alias("w"))
    found = (_by_row(texts, wanted, "inner").withColumn("lines", lines_of(F.col("text")))
             .select("doc_id", "_text_hash", "lines", F.explode("w").alias("w"))
             .select(F.struct(F.col("doc_id").alias("id"), F.col("w.pos").alias("pos")).alias("place"),
                     "_text_hash", "w.*", F.get("lines", F.col("w.pos")).alias("line")))
    ways = [rest for _, rest in _halves(F.col("line"), F.col("n"))]
    rest = F.when(F.col("way") == 0, ways[0]).when(F.col("way") == 1, ways[1]).otherwise(ways[2])
    # places without the text hash, to keep variants small: equal ones are told apart by their lines
    pairs = _near_pairs(_variants(found.withColumn("rest", rest)))
    known = found.select("place", "_text_hash", "line").distinct()
    near = (pairs.join(known, "place")
            .join(known.select(F.col("place").alias("earlier"), F.col("line").alias("before")), "earlier")
            .where(F.levenshtein("line", "before", 1) >= 0)
            .select(F.struct("place.id", "place.pos", F.col("_text_hash").alias("text")).alias("place")).distinct())
    kept = (lines.select("place").join(near, "place", "left_anti")
            .groupBy(F.col("place.id").alias("_id"), F.col("place.text").alias("_text"))
            .agg(F.collect_list("place.pos").alias("_kept")))
    all_lines = F.col("_lines")
    numbers = F.sequence(F.lit(0), F.size(all_lines) - 1)
    empty = F.filter(numbers, lambda i: F.get(all_lines, i) == "")
    stays = F.array_intersect(numbers, F.concat(
        F.coalesce("_kept", F.array().cast("array<int>")), empty))
    return (_by_row(docs, kept, "left").withColumn("_lines", lines_of(F.col("text")))
            .withColumn("_stay", stays).withColumn("_empty", F.size(empty))
            .withColumn("text", F.array_join(F.transform("_stay", lambda i: F.get(all_lines, i)), "\n"))
            .withColumn("n_lines", F.size(all_lines) - F.col("_empty"))
            .withColumn("n_kept", F.size("_stay") - F.col("_empty"))
            .select(*unpacked(names, ("doc_id", "text")), "n_lines", "n_kept"))
