"""Demographic linkage: same birth date, near collection date, similar name.

Both sides are first reduced to distinct demographics, so copies never multiply pairs. Names
that are equal pair through a plain equi join. The rest meet the references of their block (birth
date, date slot) where these are few; references of large blocks pair through a segment index
(partition based similarity join): registry names are cut into one more segment than they can have edits, so
a pair within the allowed edits has a segment untouched. A segment is keyed by birth date, date
slot, name length, number and text; a person probes, for each length that its block holds, only
the few starts at which the edits left and right of the segment can have moved it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind.functions.dates import business_days
from casebind.functions.text import has_value, name_clean
from casebind.operators.skew import HotKeys, hot_keys, lookup_join
from casebind.settings import LinkConfig
from casebind.sources.staging import unstaged

KEY = "submission_number"
PERSON = ["first_name_clean", "last_name_clean", "submitted_dob", "submitted_collection_date"]
MATCH = [
    "CASE_ID", "first_name_clean_right", "last_name_clean_right", "reference_collection_date",
    "business_day_count", "match_ratio", "reverse_match_ratio",
]
BUCKETS = ["exact", "fuzzy", "unmatched", "no_demo"]
#: References that a person of their block is compared with one by one. More go through the segment
#: index, which costs each reference some eight rows whether or not a person asks for them.
FEW = 64
#: Date slots that the join on equal names takes as one: as names are equal there, few rows meet,
#: and of wider slots fewer references belong to two.
WIDE = 8


@dataclass(frozen=True)
class LinkColumns:
    """Names of the first name, last name, birth date and collection date on one side."""

    first: str
    last: str
    dob: str
    collected: str


SUBMITTED = LinkColumns(
    "PatientFirstName", "PatientLastName", "PatientBirthDate", "SpecimenDateCollected")
LEDGER = LinkColumns(*PERSON)
REGISTRY = LinkColumns("FIRST_NAME", "LAST_NAME", "BIRTH_DATE", "SPECIMEN_COLLECTION_DTTM")


# ---- names and ratios ----------------------------------------------------------------------

def ratio(a: Column, b: Column) -> Column:
    """0-100 similarity; 100 means equal."""
    return (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))) * 100


def match_ratio(first: Column, last: Column, ref_first: Column, ref_last: Column) -> Column:
    return ratio(F.concat(first, last), F.concat(ref_first, ref_last))


def reverse_match_ratio(first: Column, last: Column, ref_first: Column, ref_last: Column) -> Column:
    """As ``match_ratio`` with the reference's first and last name swapped."""
    return ratio(F.concat(first, last), F.concat(ref_last, ref_first))


# ---- inputs --------------------------------------------------------------------------------

def people(src: DataFrame, names: LinkColumns = SUBMITTED, carry: Sequence[str] = ()) -> DataFrame:
    """Key and cleaned demographics of the source rows, plus the columns to carry along."""
    return src.select(
        KEY, *carry,
        name_clean(F.col(names.first)).alias("first_name_clean"),
        name_clean(F.col(names.last)).alias("last_name_clean"),
        F.col(names.dob).cast("date").alias("submitted_dob"),
        F.col(names.collected).cast("date").alias("submitted_collection_date"),
    )


def complete() -> Column:
    """Both names have a letter, and both dates are there."""
    return (
        has_value(F.col("first_name_clean")) & has_value(F.col("last_name_clean"))
        & F.col("submitted_dob").isNotNull() & F.col("submitted_collection_date").isNotNull()
    )


def no_demo_split(persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be linked, rows that lack demographics)."""
    return persons.filter(complete()), persons.filter(~complete())


def reference_people(ref: DataFrame, names: LinkColumns = REGISTRY) -> DataFrame:
    """Distinct demographics of the registry with their least and greatest case id.

    Ranking takes the least id, and "only one case" means the two are equal, so no id in
    between is needed.
    """
    return (
        ref.select(
            name_clean(F.col(names.first)).alias("first_name_clean_right"),
            name_clean(F.col(names.last)).alias("last_name_clean_right"),
            F.col(names.dob).cast("date").alias("ref_dob"),
            F.col(names.collected).cast("date").alias("reference_collection_date"),
            "CASE_ID",
        )
        .filter((F.col("first_name_clean_right") != "") & (F.col("last_name_clean_right") != "")
                & F.col("ref_dob").isNotNull() & F.col("reference_collection_date").isNotNull()
                & F.col("CASE_ID").isNotNull())
        .groupBy("first_name_clean_right", "last_name_clean_right", "ref_dob",
                 "reference_collection_date")
        .agg(F.min("CASE_ID").alias("CASE_ID"), F.max("CASE_ID").alias("last_case_id"))
    )


# ---- blocking ------------------------------------------------------------------------------

def edits_allowed(length: Column, threshold: int) -> Column:
    """Edits that keep a pair whose longer name has this length at or above the threshold."""
    return F.floor(length * (100 - threshold) / 100 + 1e-9).cast("int")


def segment_count(length: Column, threshold: int) -> Column:
    """One more than the edits that any partner of a name of this length may have.

    Partners are at most length * 100 / t long, which leaves length * (100 - t) / t edits: fewer
    than there are letters, so no segment is empty. Thresholds of 50 and below allow as many edits
    as letters; there the one segment is empty and only lengths can be compared.
    """
    if threshold <= 50:
        return F.lit(1)
    return F.floor(length * (100 - threshold) / threshold + 1e-9).cast("int") + 1


def _segment(length: Column, i: Column, threshold: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment ``i`` of a name of this length: as even as can be."""
    if threshold <= 50:
        return F.lit(0), F.lit(0)
    count = segment_count(length, threshold)
    start = F.floor(i * length / count).cast("int")
    return start, F.floor((i + 1) * length / count).cast("int") - start


def _key(length: Column, i: Column, text: Column, start: Column, size: Column) -> Column:
    return F.xxhash64("ref_dob", "slot", length, i, F.substring(text, start + 1, size))


def index_keys(text: Column, threshold: int) -> Column:
    """The keys of all segments of a registry name."""
    n = F.length(text)
    return F.transform(F.sequence(F.lit(0), segment_count(n, threshold) - 1), lambda i: _key(
        n, i, text, *_segment(n, i, threshold)))


def probe_keys(text: Column, lengths: Column, threshold: int) -> Column:
    """The keys that a registry name of one of ``lengths`` within the allowed edits may have.

    Take the first segment with fewer edits up to its end than its number (from 1): it is
    untouched, with i edits before it (i from 0) and so at most e - i after it. So only the first
    e + 1 segments are asked for, segment i starts at most i letters off, and from the right end
    at most e - i letters off.
    """
    n, none = F.length(text), F.array().cast("array<bigint>")

    def of_length(m: Column) -> Column:
        e = edits_allowed(F.greatest(n, m), threshold)

        def of_segment(i: Column) -> Column:
            start, size = _segment(m, i, threshold)
            low = F.greatest(-i, n - m - (e - i), -start)
            high = F.least(i, n - m + (e - i), n - size - start)
            return F.when(low <= high, F.transform(
                F.sequence(low, high), lambda s: _key(m, i, text, start + s, size))).otherwise(none)

        last = F.lit(0) if threshold <= 50 else e
        return F.flatten(F.transform(F.sequence(F.lit(0), last), of_segment))

    near = F.filter(lengths, lambda m: F.abs(n - m) <= edits_allowed(F.greatest(n, m), threshold))
    return F.array_distinct(F.flatten(F.transform(near, of_length)))


def _epoch_day(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def _slot_width(window: int, wide: int = 1) -> int:
    return (2 * window + 1) * wide


def _slot(day: Column, window: int, wide: int = 1) -> Column:
    return F.floor(_epoch_day(day) / _slot_width(window, wide)).cast("int")


def _near_slots(day: Column, window: int, wide: int = 1) -> Column:
    """The one or two date slots that hold every day within the window."""
    width = _slot_width(window, wide)
    low = F.floor((_epoch_day(day) - window) / width).cast("int")
    high = F.floor((_epoch_day(day) + window) / width).cast("int")
    return F.sequence(low, high)


def _in_window(window: int) -> Column:
    return F.abs(F.datediff("submitted_collection_date", "reference_collection_date")) <= window


def _full(first: str, last: str) -> Column:
    return F.concat(F.col(first), F.col(last))


def _probe(persons: DataFrame, link: LinkConfig, wide: int = 1) -> DataFrame:
    return persons.withColumns({
        "ref_dob": F.col("submitted_dob"),
        "full": _full("first_name_clean", "last_name_clean"),
        "slot": _slot(F.col("submitted_collection_date"), link.day_window, wide),
    })


def exact_pairs(persons: DataFrame, refs: DataFrame, link: LinkConfig) -> DataFrame:
    """Each person with the references of the same first name, last name and birth date within
    the date window, or once without any."""
    right = _by_slot(refs, link, WIDE)
    left = _probe(persons, link, WIDE).alias("l")
    right = right.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("ref_dob", "slot")]
    same += [F.col(c) == F.col(f"{c}_right") for c in ("first_name_clean", "last_name_clean")]
    return left.join(right, [*same, _in_window(link.day_window)], "left").drop(
        "full", "slot", "ref_dob")


def _by_slot(refs: DataFrame, link: LinkConfig, wide: int = 1) -> DataFrame:
    return refs.select("*", F.explode(
        _near_slots(F.col("reference_collection_date"), link.day_window, wide)).alias("slot"))


def similar_pairs(persons: DataFrame, refs: DataFrame, link: LinkConfig,
                  hot: HotKeys | None = None, stage: Callable[..., DataFrame] = unstaged) -> DataFrame:
    """Pairs of a person and a reference at or above the threshold in either name order; pairs
    may repeat.

    References of a block (birth date, date slot) with no more than ``FEW`` are compared with each
    person of it, those of larger blocks through the segment index. ``hot`` are hot blocks of the
    persons; ``stage`` writes the list of large blocks.
    """
    block = ["ref_dob", "slot"]
    if hot is None:
        hot = hot_keys(_probe(persons, link), block)
    refs = refs.withColumn("slot", _slot(F.col("reference_collection_date"), link.day_window))
    large = stage(refs.groupBy(*block).agg(F.count("*").alias("n")).filter(
        F.col("n") > FEW).drop("n"), "large_blocks")
    if large.isEmpty():
        return block_pairs(persons, refs, link, hot)
    return block_pairs(persons, refs.join(large, block, "left_anti"), link, hot).unionByName(
        segment_pairs(persons, refs.join(large, block, "left_semi").drop("slot"), link, hot))


def block_pairs(persons: DataFrame, refs: DataFrame, link: LinkConfig,
                hot: HotKeys | None = None) -> DataFrame:
    """``similar_pairs`` for references of which few share their ``slot`` and birth date: each
    moves once, and persons go to the one or two slots that their window touches."""
    left = persons.select(
        *PERSON, F.col("submitted_dob").alias("ref_dob"),
        F.explode(_near_slots(F.col("submitted_collection_date"), link.day_window)).alias("slot"))
    first, last = "first_name_clean_right", "last_name_clean_right"
    near = [F.call_function("levenshtein", F.col("full"), name, _edits(link)) >= 0
            for name in (F.col("ref_full"), _full(last, first))]
    # lengths are compared before letters
    return lookup_join(left, refs, ["ref_dob", "slot"], "inner", hot).filter(_in_window(link.day_window)).withColumns(
        {"full": _full("first_name_clean", "last_name_clean"), "ref_full": _full(first, last)}).filter(
        F.abs(F.length("full") - F.length("ref_full")) <= _edits(link)).filter(near[0] | near[1]).select(
        *PERSON, first, last, "reference_collection_date", "CASE_ID", "last_case_id")


def segment_pairs(persons: DataFrame, refs: DataFrame, link: LinkConfig,
                  hot: HotKeys | None = None) -> DataFrame:
    """``similar_pairs`` for references of any number a block.

    Both sides are first cut to the blocks (birth date, date slot) that the other has, the persons
    learning which name lengths their block holds; only what is left is cut into segments. The
    segment join is an inner join of two shuffles, so a key that many share may be split on either
    side.
    """
    return segment_matches(persons, refs, link, hot).filter(
        F.call_function("levenshtein", F.col("full"), F.col("ref_full"), _edits(link)) >= 0
    ).select(
        F.expr("left(full, cut)").alias("first_name_clean"),
        F.expr("substring(full, cut + 1)").alias("last_name_clean"),
        "submitted_dob", "submitted_collection_date",
        F.expr("IF(swapped, substring(ref_full, ref_cut + 1), left(ref_full, ref_cut))").alias("first_name_clean_right"),
        F.expr("IF(swapped, left(ref_full, ref_cut), substring(ref_full, ref_cut + 1))").alias("last_name_clean_right"),
        "reference_collection_date", "CASE_ID", "last_case_id")


def _edits(link: LinkConfig) -> Column:
    return edits_allowed(F.greatest(F.length("full"), F.length("ref_full")), link.threshold)


def segment_matches(persons: DataFrame, refs: DataFrame, link: LinkConfig,
                    hot: HotKeys | None = None) -> DataFrame:
    """What meets in the segment index, before edits are counted."""
    block, t = ["ref_dob", "slot"], link.threshold
    probe = _probe(persons.select(*PERSON), link)
    if hot is None:
        hot = hot_keys(probe, block)
    known = _by_slot(refs, link).join(probe.select(*block), block, "left_semi")
    # a name has as many letters in either order
    lengths = known.groupBy(*block).agg(F.collect_set(F.length(_full(
        "first_name_clean_right", "last_name_clean_right"))).alias("lengths"))
    left = lookup_join(probe, lengths, block, "inner", hot).select(
        F.explode(probe_keys(F.col("full"), F.col("lengths"), t)).alias("key"), "full",
        F.length("first_name_clean").alias("cut"), "submitted_dob", "submitted_collection_date")
    first, last = F.col("first_name_clean_right"), F.col("last_name_clean_right")
    orders = F.array(*[
        F.struct(F.concat(a, b).alias("ref_full"), F.length(a).alias("ref_cut"), F.lit(swapped).alias("swapped"))
        for a, b, swapped in ((first, last, False), (last, first, True))])
    right = (known.select("*", F.inline(orders))
             .filter(~F.col("swapped") | (F.concat(first, last) != F.concat(last, first)))
             .select(F.explode(index_keys(F.col("ref_full"), t)).alias("key"), "ref_full", "ref_cut",
                     "swapped", "ref_dob", "reference_collection_date", "CASE_ID", "last_case_id"))
    return left.join(right, "key").filter(
        (F.col("submitted_dob") == F.col("ref_dob")) & _in_window(link.day_window)
        & (F.abs(F.length("full") - F.length("ref_full")) <= _edits(link)))


def _near_birth_dates(a: Column, b: Column) -> Column:
    """One digit differs, or day and month have changed places."""
    digits = [F.date_format(c, "yyyyMMdd") for c in (a, b)]
    swapped = (F.year(a) == F.year(b)) & (F.month(a) == F.day(b)) & (F.day(a) == F.month(b))
    return (a != b) & (swapped | (F.levenshtein(*digits) == 1))


def birth_date_slips(persons: DataFrame, refs: DataFrame, link: LinkConfig) -> DataFrame:
    """Pairs at or above the threshold whose birth dates differ by a slip: the second pass.

    Blocks are (last name, sound of the first name, date slot), as the birth date cannot serve:
    names that differ in the last name, or sound different, are not found. An equi join of both
    sides' distinct demographics.
    """
    left = _probe(persons.select(*PERSON), link).drop("ref_dob", "full").withColumns({
        "last": F.col("last_name_clean"), "sound": F.soundex("first_name_clean")})
    right = _by_slot(refs, link).withColumns({
        "last": F.col("last_name_clean_right"), "sound": F.soundex("first_name_clean_right")})
    names = [F.col(c) for c in ("first_name_clean", "last_name_clean",
                                "first_name_clean_right", "last_name_clean_right")]
    return left.join(right, ["last", "sound", "slot"]).filter(
        _in_window(link.day_window) & _near_birth_dates(F.col("submitted_dob"), F.col("ref_dob"))
        & (match_ratio(*names) >= link.threshold)).drop("last", "sound", "slot", "ref_dob")


def candidates(persons: DataFrame, refs: DataFrame, link: LinkConfig) -> DataFrame:
    """Distinct pairs of demographics at or above the threshold, with their scores."""
    pairs = similar_pairs(persons.select(*PERSON).distinct(), refs, link)
    return _scored(pairs).select(*PERSON, *MATCH).distinct()


def _scored(pairs: DataFrame) -> DataFrame:
    names = [F.col(c) for c in ("first_name_clean", "last_name_clean",
                                "first_name_clean_right", "last_name_clean_right")]
    return pairs.withColumns({
        "match_ratio": match_ratio(*names),
        "reverse_match_ratio": reverse_match_ratio(*names),
        "business_day_count": business_days(
            F.col("submitted_collection_date"), F.col("reference_collection_date")),
    })


# ---- deciding ------------------------------------------------------------------------------

def _rank() -> Column:
    """Sorts the best pair first; null where a person has no reference.

    Higher ratio, then direct over swapped name order, fewer business days, lower case id,
    earlier date.
    """
    return F.when(F.col("CASE_ID").isNotNull(), F.struct(
        (-F.greatest("match_ratio", "reverse_match_ratio")).alias("by_ratio"),
        (-F.col("match_ratio")).alias("by_direct"),
        "business_day_count", "CASE_ID", "reference_collection_date",
        "first_name_clean_right", "last_name_clean_right", "match_ratio", "reverse_match_ratio",
    ))


def link_persons(persons: DataFrame, refs: DataFrame, link: LinkConfig,
                 stage: Callable[..., DataFrame] = unstaged) -> DataFrame:
    """One row per distinct person that has a case at or above the threshold.

    Persons with a reference of equal names are settled by it; the others are compared. All
    aggregates ignore repeated pairs. ``stage`` writes what the equal names leave, so that the
    comparison is planned with its true size.
    """
    hot = hot_keys(_probe(persons, link).filter(complete()), ["ref_dob", "slot"])
    persons = persons.filter(complete()).select(*PERSON).distinct()
    by_name = stage(
        _scored(exact_pairs(persons, refs, link)).groupBy(*PERSON)
        .agg(F.min(_rank()).alias("best"),
             (F.min("CASE_ID") == F.max("last_case_id")).alias("one_case")), "by_name")
    settled = by_name.filter(F.col("best").isNotNull())
    others = by_name.filter(F.col("best").isNull())
    compared = (
        _scored(similar_pairs(others, refs, link, hot, stage)).groupBy(*PERSON).agg(F.min(_rank()).alias("best"))
        .withColumn("one_case", F.lit(False))
    )
    if link.birth_date_slips:
        left = others.join(compared, PERSON, "left_anti")
        slips = _scored(birth_date_slips(left, refs, link)).groupBy(*PERSON).agg(F.min(_rank()).alias("best"))
        compared = compared.unionByName(slips.withColumn("one_case", F.lit(False)))
    return settled.unionByName(compared).select(
        *PERSON, *[F.col(f"best.{c}").alias(c) for c in MATCH],
        F.when(F.col("one_case"), "exact").otherwise("fuzzy").alias("bucket"))


@dataclass(frozen=True)
class LinkResult:
    """Every source row once, with ``bucket`` and the best case where there is one."""

    rows: DataFrame

    def bucket(self, *names: str) -> DataFrame:
        return self.rows.filter(F.col("bucket").isin(*names)).drop("bucket")

    @property
    def exact(self) -> DataFrame:
        return self.bucket("exact")

    @property
    def fuzzy(self) -> DataFrame:
        return self.bucket("fuzzy")

    @property
    def unmatched(self) -> DataFrame:
        return self.bucket("unmatched")

    @property
    def no_demo(self) -> DataFrame:
        return self.bucket("no_demo")

    def counts(self) -> DataFrame:
        return self.rows.groupBy("bucket").agg(F.count("*").alias("submissions"))


def bucket_metrics() -> list[Column]:
    """How many rows of a link result are in each bucket, to be counted as it is written."""
    return [F.count_if(F.col("bucket") == name).alias(name) for name in BUCKETS]


def demographic_link(src: DataFrame, ref: DataFrame, link: LinkConfig | None = None,
                     src_columns: LinkColumns = SUBMITTED, ref_columns: LinkColumns = REGISTRY,
                     carry: Sequence[str] = ("internal_create_date",),
                     hot: HotKeys | None = None, stage: Callable[..., DataFrame] = unstaged,
                     ) -> LinkResult:
    """Link source rows (one per submission) to registry cases.

    ``ref`` is the registry, or already its ``reference_people``.

    Buckets: ``exact`` (both names equal, one case), ``fuzzy`` (at or above the threshold, for human
    review; includes equal names shared by several cases), ``unmatched`` and ``no_demo``.
    """
    link = link or LinkConfig()
    persons = people(src, src_columns, carry)
    refs = ref if "last_case_id" in ref.columns else reference_people(ref, ref_columns)
    return with_links(persons, link_persons(persons, refs, link, stage), carry, hot)


def with_links(persons: DataFrame, linked: DataFrame, carry: Sequence[str] = (),
               hot: HotKeys | None = None) -> LinkResult:
    """Every row of ``persons`` with what its demographics link to."""
    keyed = persons.withColumn("_complete", complete())
    if hot is None:
        hot = hot_keys(persons, PERSON)
    rows = lookup_join(keyed, linked, PERSON, "left", hot)
    bucket = F.when(~F.col("_complete"), "no_demo").otherwise(
        F.coalesce(F.col("bucket"), F.lit("unmatched")))
    return LinkResult(rows.select(KEY, *carry, *PERSON, *MATCH, bucket.alias("bucket")))


def attach_original(result: LinkResult, original: DataFrame, hot: HotKeys | None = None,
                    columns: Sequence[str] = ()) -> DataFrame:
    """All original rows of each linked submission, with its link result: one join for all buckets."""
    original = original.select(F.col(KEY).cast("string").alias(KEY), *columns)
    return lookup_join(original, result.rows, [KEY], "inner", hot)
