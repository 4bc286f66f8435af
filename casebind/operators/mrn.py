"""Linkage by medical record number (MRN), for what demographics could not link."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind.functions.text import has_digit, has_value
from casebind.operators.linkage import LinkResult
from casebind.operators.skew import HotKeys, lookup_join
from casebind.settings import STANDARD_COLUMNS

KEY = "submission_number"
MRN_LISTS = ["CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN", "RESPNET_HOSPITALIZED_RHINO_MRN"]
SEPARATOR = ", "
ID_FIELDS = ["PatientFirstName", "PatientLastName", "SubmitterPatientNumber"]


def mrn_explode(ref: DataFrame) -> DataFrame:
    """One row per combination of the two record-number lists; a null list stays as null."""
    for column in MRN_LISTS:
        ref = ref.withColumn(column, F.explode_outer(F.split(F.col(column), SEPARATOR)))
    return ref


def mrn_pick(first: Column, second: Column) -> Column:
    """The first number if there is one, else the second."""
    return F.coalesce(first, second)


def case_mrns(ref: DataFrame) -> DataFrame:
    """Distinct (CASE_ID, MRN).

    Picking between the lists before exploding gives the same numbers as picking after, and
    never makes the product of the two lists.
    """
    numbers = F.coalesce(*[F.split(F.col(c), SEPARATOR) for c in MRN_LISTS])
    return (
        ref.filter(F.col("CASE_ID").isNotNull())
        .select("CASE_ID", F.explode(numbers).alias("MRN"))
        .filter(F.col("MRN") != "").distinct()
    )


def mrn_candidates(result: LinkResult) -> DataFrame:
    """Unlinked submissions that came with a patient number, when the link carried the raw fields."""
    return result.bucket("unmatched", "no_demo").filter(has_value(F.col("SubmitterPatientNumber")))


def mrn_recover(unlinked: DataFrame, raw: DataFrame, raw_key: str = "PHLAccessionNumber") -> DataFrame:
    """Fetch the raw name and number fields of unlinked submissions from the raw rows."""
    fields = (
        raw.filter(has_value(F.col("SubmitterPatientNumber")))
        .select(F.col(raw_key).alias(KEY), *ID_FIELDS).distinct()
    )
    return unlinked.select(KEY).join(fields, KEY, "inner")


def id_unpivot(candidates: DataFrame) -> DataFrame:
    """Each name or number field that holds a digit, as a possible record number."""
    return (
        candidates.unpivot(KEY, ID_FIELDS, "variable", "MRN")
        .filter(has_digit(F.col("MRN")))
    )


def possible_numbers(candidates: DataFrame) -> DataFrame:
    """Distinct (submission_number, MRN)."""
    return id_unpivot(candidates).select(KEY, "MRN").distinct()


def mrn_link(candidates: DataFrame, ref: DataFrame) -> DataFrame:
    """Distinct (submission_number, CASE_ID) that share a record number.

    Both sides are reduced to distinct pairs first. Each still needs its own shuffle on MRN,
    so the adaptive skew join may split a popular number on either side.
    """
    return number_pairs(possible_numbers(candidates), ref)


def number_pairs(ids: DataFrame, ref: DataFrame) -> DataFrame:
    return ids.join(case_mrns(ref), "MRN").select(KEY, "CASE_ID").distinct()


def id_matched_full(pairs: DataFrame, original: DataFrame, run_date: dt.date,
                    hot: HotKeys | None = None) -> DataFrame:
    """The standard columns of each MRN match, distinct, stamped with the run date.

    Rows move once: what repeats is dropped after the pairs are met, not before as well.
    """
    rows = original.select(F.col(KEY).cast("string").alias(KEY), *STANDARD_COLUMNS)
    return (
        lookup_join(rows, pairs, [KEY], "inner", hot)
        .select(KEY, F.lit(run_date).alias("internal_create_date"), "CASE_ID", *STANDARD_COLUMNS)
        .distinct()
    )
