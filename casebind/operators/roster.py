"""The fixed-layout roster, and its de-duplication against the registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions import codes
from casebind.functions.flags import reportable
from casebind.functions.text import strip
from casebind.operators.frames import keep_one, quote, union_all, union_diagonal

_PERSON = {
    "PARTY_EXTERNAL_ID": "EXTERNAL_ID", "FIRST_NAME": "FIRST_NAME",
    "MIDDLE_NAME": "MIDDLE_NAME", "LAST_NAME": "LAST_NAME", "DOB": "BIRTH_DATE",
}
_LAB = [
    "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "WDRS_SPECIMEN_TYPE",
    "WDRS_SPECIMEN_SOURCE", "WDRS_TEST_PERFORMED", "WDRS_RESULT", "WDRS_RESULT_SUMMARY",
    "SUBMITTER", "SUBMITTER_OTHER",
]


def positive_only(matched: DataFrame) -> DataFrame:
    return matched.filter(reportable(F.col("WDRS_RESULT"), F.col("WDRS_RESULT_SUMMARY")))


def case_persons(ref: DataFrame) -> DataFrame:
    """One row per case with the person columns of the roster."""
    return keep_one(
        ref.select(F.col("CASE_ID").alias("CaseID"),
                   *[F.col(old).alias(new) for new, old in _PERSON.items()]),
        ["CaseID"])


def roster_enrich(matched: DataFrame, ref: DataFrame) -> DataFrame:
    """Distinct matched lab rows with the person columns of their case."""
    labs = matched.select(F.col("CASE_ID").alias("CaseID"), "WDRS_PERFORMING_ORG", *_LAB).distinct()
    return labs.join(case_persons(ref), "CaseID", "left")


def create_roster(matched: DataFrame, ref: DataFrame, run_date: dt.date) -> DataFrame:
    """Roster rows of the positive matches, one per case, dates, result and summary.

    Labs and persons are each reduced to one row per key before they meet, so a case with many
    labs on either side does not multiply rows.
    """
    labs = positive_only(matched).select(
        F.col("CASE_ID").alias("CaseID"),
        F.col("WDRS_PERFORMING_ORG").alias("PERFORMING_LAB_ENTIRE_REPORT"), *_LAB)
    rows = keep_one(labs, S.ROSTER_KEY,
                    [c for c in S.ROSTER_COLUMNS if c in labs.columns and c not in S.ROSTER_KEY])
    rows = rows.join(case_persons(ref), "CaseID", "left")
    fixed = {"CODE": F.lit(S.DEFAULT_CASE_CODE), "Case.Note": codes.roster_note(run_date)}
    fixed |= {name: F.lit("") for name in S.ROSTER_BLANKS}
    empty = F.lit(None).cast("string")
    return rows.select(*[
        F.col(name) if name in rows.columns else fixed.get(name, empty).alias(name)
        for name in S.ROSTER_COLUMNS
    ])


def _registry_labs(ref: DataFrame) -> DataFrame:
    return ref.select(
        F.col("CASE_ID").alias("CaseID"), strip(F.col("WDRS__RESULT")).alias("known_label"),
        F.col("SPECIMEN_COLLECTION_DTTM").cast("date").alias("known_date")).distinct()


def not_in_registry(roster: DataFrame, ref: DataFrame) -> DataFrame:
    """Drop roster rows whose case already has that result on that collection date."""
    labelled = roster.withColumns({
        "known_label": strip(codes.label_of_code(F.col("WDRS_RESULT"))),
        "known_date": F.col("SPECIMEN_COLLECTION_DTTM"),
    })
    return labelled.join(
        _registry_labs(ref), ["CaseID", "known_label", "known_date"], "left_anti"
    ).select(*map(quote, S.ROSTER_COLUMNS))


def dedup_roster(roster: DataFrame, ref: DataFrame) -> DataFrame:
    return not_in_registry(roster, ref).distinct()


def dedup_roster_row_wise(roster: DataFrame, ref: DataFrame) -> DataFrame:
    """The rule as first written: compares the (blank) roster label, and one registry row that
    differs is enough to keep a roster row."""
    # a row goes only if its case has one registry row and that one is the same
    known = _registry_labs(ref).groupBy("CaseID").agg(
        F.count("*").alias("n"), F.first("known_label").alias("known_label"),
        F.first("known_date").alias("known_date"))
    same = (F.col("n") == 1) & (strip(F.col("TEST_RESULT")) == F.col("known_label")) & (
        F.col("SPECIMEN_COLLECTION_DTTM") == F.col("known_date"))
    return (
        roster.join(known, "CaseID", "left")
        .filter(~F.coalesce(same, F.lit(False)))
        .select(*map(quote, S.ROSTER_COLUMNS)).distinct()
    )


def union_rosters(main: DataFrame, rematch: DataFrame, reviewed: DataFrame, ref: DataFrame,
                  run_date: dt.date, cases: DataFrame | None = None) -> DataFrame:
    """(main and rematch matches) as a de-duplicated roster, plus the reviewed roster.

    ``cases`` has the person columns of ``ref`` without its labs, where that is at hand.
    """
    combined = create_roster(union_diagonal(main, rematch), ref if cases is None else cases, run_date)
    return union_all(not_in_registry(combined, ref), reviewed)
