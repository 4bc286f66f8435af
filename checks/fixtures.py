"""Test inputs derived from the driver's tables, in SQL that Spark and DuckDB both run.

A submission is an order, an analyte row is a line item, a person is a customer. The ledgers
hold what an earlier run would have left: urgent orders are rostered, high-priority ones are
open or closed non-matches, low-priority ones are under review.
"""

from __future__ import annotations

import datetime as dt
import re

RUN_DATE = dt.date(2024, 6, 1)

_FIRST = "translate(substr(md5('f' || CAST({k} AS STRING)),1,8),'0123456789','ghijklmnop')"
_LAST = "translate(substr(md5('l' || CAST({k} AS STRING)),1,8),'0123456789','ghijklmnop')"
_DOB = "DATE '1940-01-01' + CAST(({k} * 37) % 25000 AS INT)"


def _first(k):
    return _FIRST.format(k=k)


def _last(k):
    return _LAST.format(k=k)


def _dob(k):
    return _DOB.format(k=k)


def _slots(case: str) -> str:
    """Slots 1..(case % 5) are filled; the others are null or empty."""
    filled = {"tsttyp": "'2'", "poststdt": "'2024-01-0{i}'", "tstres": "'1'", "hosplab": "'LAB{i}'"}
    return ",\n ".join(
        f"CASE WHEN {case} % 5 >= {i} THEN {value.format(i=i)} "
        f"WHEN {case} % 2 = 0 THEN '' END AS {name}{i}"
        for i in range(1, 5) for name, value in filled.items())


def _submissions(orders: str = "orders", more: str = "") -> str:
    # what depends on the order alone is worked out before the line items fan it out; the hint
    # (a comment to DuckDB) gives small data the sort-merge join that big tables get anyway
    return f"""
SELECT /*+ MERGE(o) */ PHLAccessionNumber, PatientFirstName, PatientLastName, PatientBirthDate, SpecimenDateCollected,
 SpecimenDateReceived, SubmitterPatientNumber, SubmitterName{more},
 CASE l_linenumber % 6 WHEN 0 THEN 'Nasal Swabs' WHEN 1 THEN 'Nasopharyngeal Swab (NP)'
   WHEN 2 THEN 'Respiratory: NP swab' WHEN 3 THEN 'Conjunctival swab' WHEN 4 THEN 'random' END AS SpecimenSource,
 CASE (l_orderkey * 7 + l_linenumber * 3) % 12
   WHEN 0 THEN 'Influenza A virus detected by RT-PCR {{58}}'
   WHEN 1 THEN 'Influenza A(2009 H1N1) virus detected by RT-PCR {{65}}'
   WHEN 2 THEN 'Influenza A(H3) virus detected by RT-PCR {{64}}'
   WHEN 3 THEN 'Influenza A(H5) virus detected by RT-PCR {{70}}'
   WHEN 4 THEN 'Influenza A(H7) virus detected by RT-PCR'
   WHEN 5 THEN 'Influenza B virus detected by RT-PCR {{59}}'
   WHEN 6 THEN 'Influenza B/Victoria lineage detected by RT-PCR {{91}}'
   WHEN 7 THEN 'Influenza B/Yamagata lineage detected by RT-PCR {{91}}'
   WHEN 8 THEN 'Inconclusive - Invalid Result {{68}}'
   WHEN 9 THEN 'Influenza A virus detected by RT-PCR; Subtype undetected {{66}}'
   WHEN 10 THEN ' RP ' END AS ResultTextConclusion,
 CASE (l_orderkey + l_linenumber) % 5 WHEN 0 THEN 'Not Detected {{52}}' WHEN 1 THEN 'Test {{53}}'
   ELSE 'Detected {{51}}' END AS TestResult
FROM (SELECT o_orderkey, 'WA' || CAST(o_orderkey AS STRING) AS PHLAccessionNumber,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'M' || CAST(o_custkey AS STRING)
      WHEN o_orderkey % 5 = 0 THEN 'Q' || substr({_first('o_custkey')},2)
      ELSE {_first('o_custkey')} END AS PatientFirstName,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'zzzz'
      ELSE upper({_last('o_custkey')}) END AS PatientLastName,
 CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(month({_dob('o_custkey')}) AS STRING) || '/' ||
   CAST(day({_dob('o_custkey')}) AS STRING) || '/' || CAST(year({_dob('o_custkey')}) AS STRING) END AS PatientBirthDate,
 CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INT) END AS SpecimenDateCollected,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 + 2 AS INT) AS SpecimenDateReceived,
 CASE o_custkey % 3 WHEN 0 THEN 'M' || CAST(o_custkey AS STRING) WHEN 1 THEN '' END AS SubmitterPatientNumber,
 CASE o_orderkey % 4 WHEN 0 THEN 'Valley Medical Center' WHEN 1 THEN 'Everett Clinic Laboratory'
   WHEN 2 THEN 'some random lab' END AS SubmitterName{more}
 FROM {orders}) o JOIN lineitem ON l_orderkey = o_orderkey"""


FIXTURES = {
    "wizard": f"""
SELECT c_custkey + 100000 AS CASE_ID, 'RC' || CAST(c_custkey AS STRING) AS RESPNET_CASE_ID,
 'EX' || CAST(c_custkey AS STRING) AS EXTERNAL_ID,
 {_first('c_custkey')} AS FIRST_NAME, CAST(NULL AS STRING) AS MIDDLE_NAME,
 {_last('c_custkey')} AS LAST_NAME, {_dob('c_custkey')} AS BIRTH_DATE,
 CASE WHEN c_custkey % 4 = 0 THEN 'M' || CAST(c_custkey AS STRING) || ', N' || CAST(c_custkey AS STRING) END
   AS CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN,
 CASE WHEN c_custkey % 6 = 0 THEN 'R' || CAST(c_custkey AS STRING) END AS RESPNET_HOSPITALIZED_RHINO_MRN
FROM customer""",
    "investigation": """
SELECT o_custkey + 100000 AS CASE_ID, CAST(o_orderdate AS DATE) AS SPECIMEN__COLLECTION__DTTM,
 CASE o_orderkey % 3 WHEN 0 THEN 'Influenza A detected' WHEN 1 THEN 'Influenza A (H3) detected'
   ELSE 'Influenza B detected' END AS WDRS__RESULT
FROM orders WHERE o_orderkey % 2 = 0""",
    "registry_events": """
SELECT o_orderkey AS EVENT_ID, o_custkey + 100000 AS CASE_ID,
 CASE o_orderstatus WHEN 'P' THEN 'RSVHP' ELSE 'FLUHP' END AS CODE,
 CAST(o_orderdate AS DATE) AS EVENT_DATE
FROM orders""",
    "submissions": _submissions(),
    "history": """
SELECT 'WA' || CAST(o_orderkey AS STRING) AS submission_number, o_custkey + 100000 AS CASE_ID,
 o_orderpriority AS priority, o_orderstatus = 'F' AS match_found,
 CAST(o_orderdate AS DATE) AS reference_collection_date
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')""",
    "form_records": f"""
SELECT CAST(c_custkey + 100000 AS STRING) AS wdrs_case_id,
 {_slots('(c_custkey + 100000)')}
FROM customer""",
    "messy_dates": """
SELECT o_orderkey, CASE o_orderkey % 7
   WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
   WHEN 1 THEN lpad(CAST(month(o_orderdate) AS STRING),2,'0') || '-' || lpad(CAST(day(o_orderdate) AS STRING),2,'0') || '-' || CAST(year(o_orderdate) AS STRING)
   WHEN 2 THEN CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April'
     WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September'
     WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END || ' ' || CAST(day(o_orderdate) AS STRING) || ', ' || CAST(year(o_orderdate) AS STRING)
   WHEN 3 THEN CAST(DAYS_BETWEEN(DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS STRING)
   WHEN 4 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)
   WHEN 5 THEN 'not a date' END AS text
FROM orders""",
    "alt_results": """
SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 8
   WHEN 0 THEN 'Influenza A H1N1 detected' WHEN 1 THEN 'Influenza A H3N2 detected' WHEN 2 THEN 'Influenza B detected'
   WHEN 3 THEN 'Influenza A virus detected by RT-PCR {58}' WHEN 4 THEN 'Influenza virus not detected by RT-PCR {60}'
   WHEN 5 THEN ' RP ' WHEN 6 THEN 'Influenza A(H5) virus detected by RT-PCR {70}' END AS text
FROM lineitem""",
}

# the one spelling the two engines do not share
_DAYS = re.compile(r"DAYS_BETWEEN\((.+?), (CAST\(\w+ AS DATE\))\)")


def spark_sql(name: str) -> str:
    return _DAYS.sub(r"datediff(\2, \1)", FIXTURES[name])


def submissions_with_history() -> str:
    """For Spark: the submissions, each with a list of what ``history`` says of it (null: nothing).

    The history is of orders, so it is joined to these, on their key, before the line items fan
    them out; wide rows need not be shuffled once more to meet it.
    """
    return _submissions(f"""orders LEFT JOIN (
 SELECT CAST(substr(submission_number, 3) AS BIGINT) AS history_key,
  collect_list(struct(CASE_ID, priority, match_found, reference_collection_date)) AS history
 FROM ({spark_sql("history")}) GROUP BY 1) ON o_orderkey = history_key""", ", history")


def duckdb_sql(name: str) -> str:
    return _DAYS.sub(r"(\2 - \1)", FIXTURES[name])


BASE_TABLES = ["orders", "lineitem", "customer"]
