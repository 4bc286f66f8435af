"""Repeating lab slots of the wide form table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions import codes
from casebind.functions.text import has_value, split_field_slot
from casebind.operators.frames import columns_matching, dates_as_text

SLOTS = range(1, S.FORM_SLOTS + 1)
SLOT_COLUMNS = [f"{field}{slot}" for slot in SLOTS for field in S.FORM_FIELDS]


def form_unpivot(forms: DataFrame, case: str = "wdrs_case_id") -> DataFrame:
    """Wide slots to (case, variable, value)."""
    slots = columns_matching(forms, "|".join(S.FORM_FIELDS), exclude="covid|rsv")
    return forms.select(
        F.col(case).alias("CaseID"), *[F.col(c).cast("string").alias(c) for c in slots]
    ).unpivot("CaseID", slots, "variable", "value")


def slot_pivot(long: DataFrame) -> DataFrame:
    """(case, variable, value) to one row per case and slot; the greatest value where several.

    A greatest text is found by sorting, so the rows are first dealt out: a task that has made
    many long rows of few wide ones would sort them all. All columns deal, as a case may be hot.
    """
    field, slot = split_field_slot(F.col("variable"))
    return (
        long.repartition("CaseID", "variable", "value").select("CaseID", field.alias("field"), slot.alias("lab_number"), "value")
        .groupBy("CaseID", "lab_number").pivot("field", S.FORM_FIELDS).agg(F.max("value"))
    )


def _is_free(lab: Column, posted: Column) -> Column:
    return ~has_value(lab) & ~has_value(posted)


def first_empty_slot(slots: DataFrame) -> DataFrame:
    """Lowest free slot of each case; cases whose first slot is free, or none is, drop out."""
    free = F.when(_is_free(F.col("hosplab"), F.col("poststdt")), F.col("lab_number"))
    return (
        slots.groupBy("CaseID").agg(F.min(free).alias("first_empty_lab"))
        .filter(F.col("first_empty_lab") != 1)
    )


def case_free_slot(forms: DataFrame, case: str = "wdrs_case_id") -> DataFrame:
    """As unpivot, pivot and ``first_empty_slot`` together, without making rows long.

    The slots of a form sit side by side, so one aggregate per case and a ``coalesce`` do.
    """
    per_case = forms.groupBy(F.col(case).cast("string").alias("CaseID")).agg(*[
        F.max(F.col(f"{field}{slot}").cast("string")).alias(f"{field}{slot}")
        for slot in SLOTS for field in ("hosplab", "poststdt")
    ])
    first = F.coalesce(*[
        F.when(_is_free(F.col(f"hosplab{i}"), F.col(f"poststdt{i}")), i) for i in SLOTS])
    return per_case.select("CaseID", first.alias("first_empty_lab")).filter(
        F.col("first_empty_lab") != 1)


def form_join(roster: DataFrame, forms: DataFrame) -> DataFrame:
    """Roster rows whose case has a form with a later free slot.

    A roster has one row per case, dates and result, so no case can hold a large share of it.
    """
    lab = roster.select(
        F.col("CaseID").cast("string").alias("CaseID"), "PARTY_EXTERNAL_ID",
        "WDRS_TEST_PERFORMED", "WDRS_RESULT", "SPECIMEN_COLLECTION_DTTM")
    return lab.join(case_free_slot(forms), "CaseID")


def slot_fill(rows: DataFrame) -> DataFrame:
    """Write test, date, result and lab name into the free slot's columns; the others are null."""
    values = {
        "tsttyp": codes.form_test_code(F.col("WDRS_TEST_PERFORMED")),
        "poststdt": F.col("SPECIMEN_COLLECTION_DTTM"),
        "tstres": codes.form_result_code(F.col("WDRS_RESULT")),
        "hosplab": F.lit(S.FORM_LAB_NAME),
    }
    return rows.withColumns({
        f"{field}{slot}": F.when(F.col("first_empty_lab") == slot, value)
        for field, value in values.items() for slot in SLOTS
    })


def form_updates(roster: DataFrame, forms: DataFrame, ref: DataFrame) -> DataFrame:
    """Form rows to import: ids and the filled slot of every rostered case that has a form."""
    filled = slot_fill(form_join(roster, forms)).select(
        "CaseID", "PARTY_EXTERNAL_ID", *SLOT_COLUMNS).distinct()
    local_ids = ref.select(
        F.col("CASE_ID").cast("string").alias("CaseID"), "RESPNET_CASE_ID").distinct()
    return filled.join(local_ids, "CaseID").select(
        F.col("CaseID").alias("wdrs_case_id"),
        F.col("PARTY_EXTERNAL_ID").alias("party_external_id"),
        F.col("RESPNET_CASE_ID").alias("caseid"),
        *SLOT_COLUMNS,
    ).distinct()


def form_updates_text(updates: DataFrame) -> DataFrame:
    """Dates as ISO text, ready for JSON."""
    return dates_as_text(updates)
