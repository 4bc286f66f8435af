"""Raw submissions to registry codes, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from casebind import settings as S
from casebind.functions import codes
from casebind.functions.dates import bare_date, parse_bare_date

_DAYS = ["PatientBirthDate", "SpecimenDateCollected", "SpecimenDateReceived"]


def _is_day(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DateType, TimestampType))


def standardize(df: DataFrame) -> DataFrame:
    """Add the registry columns.

    What two columns share (the rule that fits, the PCR test, the lab code) or one reads several
    times (dates as text) is worked out first and once, which also keeps the generated code small
    enough to be compiled to machine code.
    """
    text, specimen, lab = F.col("ResultTextConclusion"), F.col("SpecimenSource"), F.col("SubmitterName")
    days = {c: F.col(c).cast("date") if _is_day(df, c) else parse_bare_date(F.col(f"_{c}")) for c in _DAYS}
    bare = [c for c in _DAYS if not _is_day(df, c)]
    shared = df.withColumns({
        # a date column stays as it is, a timestamp is cut to its day, text parsed
        **{f"_{c}": bare_date(F.col(c)) for c in bare},
        "_rule": codes.first_rule(text, S.RESULT_RULES),
        "_pcr": codes.is_pcr(text),
        "SUBMITTER": codes.submitter_code(lab),
    })
    return shared.withColumns({
        "WDRS_RESULT": codes.rule_value(F.col("_rule"), text, S.RESULT_RULES),
        "TEST_RESULT": codes.rule_value(F.col("_rule"), text, S.RESULT_RULES, labels=True),
        "WDRS_TEST_PERFORMED": F.when(F.col("_pcr"), S.TEST_PCR_CODE),
        "TEST_PERFORMED_DESC": F.when(F.col("_pcr"), S.TEST_PCR_LABEL),
        "WDRS_SPECIMEN_SOURCE": codes.specimen_site_code(specimen),
        "SPECIMEN_SOURCE_SITE": codes.specimen_site_label(specimen),
        "WDRS_SPECIMEN_TYPE": codes.specimen_type_code(specimen),
        "SPECIMEN_TYPE": codes.specimen_type_label(specimen),
        "SPECIMEN_COLLECTION_DTTM": days["SpecimenDateCollected"],
        "SPECIMEN_RECEIVED_DTTM": days["SpecimenDateReceived"],
        "SUBMITTER_OTHER": codes.submitter_other(F.col("SUBMITTER"), lab),
        "WDRS_PERFORMING_ORG": codes.performing_lab(),
        "PERFORMING_LAB_ENTIRE_REPORT": codes.performing_lab(),
        "WDRS_RESULT_SUMMARY": codes.result_summary(F.col("TestResult")),
        "PatientBirthDate": days["PatientBirthDate"],
        "SpecimenDateCollected": days["SpecimenDateCollected"],
    }).drop("_rule", "_pcr", *[f"_{c}" for c in bare])
