"""The registered queries again, in DuckDB SQL.

Written for clarity: linkage compares every pair of a birth date, duplicates go through window
functions, slots through unpivoted rows. Named parts build on each other and each query pulls in
the ones it mentions.
"""

from __future__ import annotations

import re

from casebind import settings as S
from checks.fixtures import FIXTURES, RUN_DATE, duckdb_sql

DAY = f"DATE '{RUN_DATE}'"
STD = ", ".join(S.STANDARD_COLUMNS)
PERSON = "first_name_clean, last_name_clean, submitted_dob, submitted_collection_date"
MATCH = ("CASE_ID, first_name_clean_right, last_name_clean_right, reference_collection_date, "
         "business_day_count, match_ratio, reverse_match_ratio")
FUZZY_INPUT = ", ".join(S.FUZZY_INPUT_COLUMNS)
RAW = sorted(["submission_number", "internal_create_date", "PHLAccessionNumber", "PatientFirstName",
              "PatientLastName", "PatientBirthDate", "SpecimenDateCollected", "SpecimenDateReceived",
              "SubmitterPatientNumber", "SubmitterName", "SpecimenSource", "ResultTextConclusion",
              "TestResult"])


def _q(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _rules(x: str, rules, column: int) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {_q(r[0])}) THEN {_q(r[column])}" for r in rules)
    return f"CASE {whens} ELSE {_strip(x)} END"


def _lookup(x: str, table: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v if isinstance(v, int) else _q(v)}" for k, v in table.items())
    return f"CASE {x} {whens} ELSE {default} END"


def _specimen(column: int) -> str:
    return _lookup("SpecimenSource", {k: v[column] for k, v in S.SPECIMENS.items()})


ALT = [(S.ALT_RESULT_PATTERNS.get(code, pattern), code, label) for pattern, code, label in S.RESULT_RULES]
RESULT = _rules("ResultTextConclusion", S.RESULT_RULES, 1)
LABEL = _rules("ResultTextConclusion", S.RESULT_RULES, 2)
TEST = """CASE WHEN regexp_matches(upper(ResultTextConclusion), '51|INCONCLUSIVE') THEN NULL
 WHEN regexp_matches(upper(ResultTextConclusion), 'RT-PCR') THEN {} END"""
SUMMARY = "CASE WHEN contains(TestResult,'51') THEN 'G_POSITIVE' WHEN contains(TestResult,'52') THEN 'G_NEGATIVE' END"
SUBMITTER = _lookup("SubmitterName", S.SUBMITTER_CODES, "'27782022'")
FORM_TEST = _lookup("WDRS_TEST_PERFORMED", S.FORM_TEST_CODES)
FORM_RESULT = _lookup("WDRS_RESULT", S.FORM_RESULT_CODES | S.FORM_RESULT_ADDITIONS)
CODE_LABEL = _lookup("WDRS_RESULT", {c: label for _, c, label in S.RESULT_RULES}, "WDRS_RESULT")
ACCEPTED = ", ".join(map(_q, S.ACCEPTED_RESULTS))
SUBTYPES = ", ".join(map(_q, S.SUBTYPE_CODES))


def _clean(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^\\p{{L}}\\p{{M}}]', '', 'g'))"


def _weekdays(a: str, b: str) -> str:
    """Counted one day at a time."""
    return (f"CAST(len(list_filter(generate_series(CAST(least({a},{b}) AS TIMESTAMP) + INTERVAL 1 DAY, "
            f"CAST(greatest({a},{b}) AS TIMESTAMP), INTERVAL 1 DAY), lambda d: isodow(d) < 6)) AS BIGINT)")


def _ratio(a: str, b: str) -> str:
    return f"(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))) * 100"


def _first_row(source: str, keys: str, order: str, columns: str) -> str:
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) rn "
            f"FROM {source}) WHERE rn = 1")


def _without(columns: str, *names: str) -> str:
    return ", ".join(c for c in map(str.strip, columns.split(",")) if c not in names)


COMPLETE = ("first_name_clean <> '' AND last_name_clean <> '' AND submitted_dob IS NOT NULL "
            "AND submitted_collection_date IS NOT NULL")


def _link_parts(name: str, people: str, carry: str) -> dict[str, str]:
    """``{name}_link``: every row of ``people`` with its bucket and best case, by brute force."""
    return {
        f"{name}_pairs": f"""
SELECT p.submission_number, r.CASE_ID, r.f AS first_name_clean_right, r.l AS last_name_clean_right,
 r.d AS reference_collection_date, {_weekdays('p.submitted_collection_date', 'r.d')} AS business_day_count,
 {_ratio('p.first_name_clean || p.last_name_clean', 'r.f || r.l')} AS match_ratio,
 {_ratio('p.first_name_clean || p.last_name_clean', 'r.l || r.f')} AS reverse_match_ratio,
 p.first_name_clean = r.f AND p.last_name_clean = r.l AS same_names
FROM {people} p JOIN ref_people r ON p.submitted_dob = r.BIRTH_DATE
 AND abs(p.submitted_collection_date - r.d) <= 5
WHERE {COMPLETE}""",
        f"{name}_good": f"SELECT * FROM {name}_pairs WHERE greatest(match_ratio, reverse_match_ratio) >= 80",
        f"{name}_best": f"""
SELECT g.*, CASE WHEN n_same = 1 THEN 'exact' ELSE 'fuzzy' END AS bucket FROM (
 SELECT *, row_number() OVER (PARTITION BY submission_number ORDER BY same_names DESC, greatest(match_ratio, reverse_match_ratio) DESC,
  match_ratio DESC, business_day_count, CASE_ID, reference_collection_date, first_name_clean_right, last_name_clean_right) rn,
  count(DISTINCT CASE WHEN same_names THEN CASE_ID END) OVER (PARTITION BY submission_number) n_same
 FROM {name}_good) g WHERE rn = 1""",
        f"{name}_link": f"""
SELECT p.submission_number, {carry} {', '.join('p.' + c.strip() for c in PERSON.split(','))}, {MATCH},
 CASE WHEN ({COMPLETE}) IS NOT TRUE THEN 'no_demo' ELSE coalesce(b.bucket, 'unmatched') END AS bucket
FROM {people} p LEFT JOIN {name}_best b USING (submission_number)""",
    }


def _ledger(priority: str) -> str:
    return f"""
SELECT submission_number, internal_create_date, h.CASE_ID, {_clean('PatientFirstName')} AS first_name_clean,
 {_clean('PatientLastName')} AS last_name_clean, PatientBirthDate AS submitted_dob,
 SpecimenDateCollected AS submitted_collection_date, h.reference_collection_date, {STD}, h.match_found
FROM std JOIN history h USING (submission_number) WHERE priority = '{priority}'"""


def _people(source: str, carry: str = "") -> str:
    return f"""SELECT submission_number, {carry} {_clean('PatientFirstName')} AS first_name_clean,
 {_clean('PatientLastName')} AS last_name_clean, PatientBirthDate AS submitted_dob,
 SpecimenDateCollected AS submitted_collection_date FROM {source}"""


RAW_IDS = "internal_create_date, PatientFirstName, PatientLastName, SubmitterPatientNumber,"
P_RAW_IDS = "p.internal_create_date, p.PatientFirstName, p.PatientLastName, p.SubmitterPatientNumber,"


def _several(source: str, condition: str) -> str:
    return f"""SELECT submission_number, count(DISTINCT WDRS_RESULT) AS n FROM {source}
WHERE {condition} GROUP BY submission_number HAVING count(DISTINCT WDRS_RESULT) > 1"""


MULTI = (f"contains(WDRS_RESULT_SUMMARY,'G_POSITIVE') AND NOT contains(TEST_RESULT,'RP') "
         f"AND WDRS_RESULT IN ({SUBTYPES})")


def _flags(source: str) -> str:
    return f"""
SELECT *, qa_wdrs_result OR qa_wdrs_result_summary OR qa_multiple_subtypes OR qa_missing_dob AS qa_flag FROM (
 SELECT *, (WDRS_RESULT NOT IN ({ACCEPTED}) OR WDRS_RESULT IS NULL) AS qa_wdrs_result,
  (WDRS_RESULT_SUMMARY NOT IN ('G_POSITIVE','G_NEGATIVE') OR WDRS_RESULT_SUMMARY IS NULL) AS qa_wdrs_result_summary,
  coalesce(PatientFirstName <> '' AND PatientLastName <> '' AND PatientBirthDate IS NULL
   AND NOT regexp_matches(PatientFirstName, '\\d') AND NOT regexp_matches(PatientLastName, '\\d'), FALSE) AS qa_missing_dob
 FROM {source})"""


def _ids(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT submission_number, '{c}' AS variable, {c} AS MRN FROM {source} WHERE regexp_matches({c}, '\\d')"
        for c in ("PatientFirstName", "PatientLastName", "SubmitterPatientNumber"))


def _id_full(pairs: str, original: str) -> str:
    return f"""SELECT DISTINCT submission_number, {DAY} AS internal_create_date, CASE_ID, {STD}
FROM {pairs} JOIN (SELECT submission_number, {STD} FROM {original}) USING (submission_number)"""


PERSON_COLUMNS = "PARTY_EXTERNAL_ID, FIRST_NAME, MIDDLE_NAME, LAST_NAME, DOB"
_ROSTER_TYPED = {
    "CODE": "'FLUHP'", "PERFORMING_LAB_ENTIRE_REPORT": "WDRS_PERFORMING_ORG",
    "PARTY_EXTERNAL_ID": "EXTERNAL_ID", "FIRST_NAME": "FIRST_NAME", "MIDDLE_NAME": "MIDDLE_NAME",
    "LAST_NAME": "LAST_NAME", "DOB": "BIRTH_DATE", "CaseID": "m.CASE_ID",
    "Case.Note": f"'Updated event via GCD RESPNET Lab Result (add lab) roster on {RUN_DATE} from PHL subtyping'",
    **{c: "''" for c in S.ROSTER_BLANKS},
    **{c: f"m.{c}" for c in (
        "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "WDRS_SPECIMEN_TYPE", "WDRS_SPECIMEN_SOURCE",
        "WDRS_TEST_PERFORMED", "WDRS_RESULT", "WDRS_RESULT_SUMMARY", "SUBMITTER", "SUBMITTER_OTHER")},
}
ROSTER_SELECT = ", ".join(
    f'{_ROSTER_TYPED.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in S.ROSTER_COLUMNS)
ROSTER_NAMES = ", ".join(f'"{c}"' for c in S.ROSTER_COLUMNS)
ROSTER_KEY = ", ".join(S.ROSTER_KEY)


def _roster(matched: str) -> str:
    rest = ", ".join(f'"{c}"' for c in S.ROSTER_COLUMNS if c not in S.ROSTER_KEY)
    rows = (f"(SELECT {ROSTER_SELECT} FROM {matched} m LEFT JOIN registry r ON m.CASE_ID = r.CASE_ID "
            "WHERE contains(m.WDRS_RESULT_SUMMARY,'G_POSITIVE') AND m.WDRS_RESULT <> 'RP')")
    return _first_row(rows, ROSTER_KEY, rest, ROSTER_NAMES)


def _dedup(rows: str) -> str:
    return f"""SELECT DISTINCT {ROSTER_NAMES} FROM {rows} x WHERE NOT EXISTS (
 SELECT 1 FROM registry g WHERE g.CASE_ID = x.CaseID AND {_strip('g.WDRS__RESULT')} = {_strip(CODE_LABEL)}
  AND g.SPECIMEN_COLLECTION_DTTM = x.SPECIMEN_COLLECTION_DTTM)"""


SLOTS = [(f, i) for i in range(1, 5) for f in S.FORM_FIELDS]
SLOT_NAMES = ", ".join(f"{f}{i}" for f, i in SLOTS)
_FILL = {"tsttyp": FORM_TEST, "poststdt": "SPECIMEN_COLLECTION_DTTM", "tstres": FORM_RESULT, "hosplab": "'WAPHL'"}
SLOT_FILL = ", ".join(f"CASE WHEN first_empty_lab = {i} THEN {_FILL[f]} END AS {f}{i}" for f, i in SLOTS)


def _form_parts(name: str, rows: str) -> dict[str, str]:
    return {
        f"{name}_form_rows": f"""SELECT CAST(x.CaseID AS VARCHAR) AS CaseID, PARTY_EXTERNAL_ID, WDRS_TEST_PERFORMED, WDRS_RESULT,
 SPECIMEN_COLLECTION_DTTM, first_empty_lab FROM {rows} x JOIN free_slot f ON CAST(x.CaseID AS VARCHAR) = f.CaseID""",
        f"{name}_form_filled": f"SELECT CaseID, PARTY_EXTERNAL_ID, {SLOT_FILL} FROM {name}_form_rows",
        f"{name}_form_updates": f"""SELECT DISTINCT CaseID AS wdrs_case_id, PARTY_EXTERNAL_ID AS party_external_id,
 RESPNET_CASE_ID AS caseid, {SLOT_NAMES}
FROM {name}_form_filled JOIN registry r ON CaseID = CAST(r.CASE_ID AS VARCHAR)""",
    }


PARTS: dict[str, str] = {name: duckdb_sql(name) for name in FIXTURES}
PARTS |= {
    "registry": """SELECT w.*, v.* EXCLUDE (CASE_ID, SPECIMEN__COLLECTION__DTTM),
 v.SPECIMEN__COLLECTION__DTTM AS SPECIMEN_COLLECTION_DTTM
FROM wizard w LEFT JOIN investigation v ON w.CASE_ID = v.CASE_ID""",
    "raw": f"SELECT CAST(PHLAccessionNumber AS VARCHAR) AS submission_number, {DAY} AS internal_create_date, * FROM submissions",
    "std": f"""
SELECT * EXCLUDE (PatientBirthDate), CAST(try_strptime(PatientBirthDate, '%m/%d/%Y') AS DATE) AS PatientBirthDate,
 {RESULT} AS WDRS_RESULT, {LABEL} AS TEST_RESULT, {TEST.format("'G_PCR'")} AS WDRS_TEST_PERFORMED,
 {TEST.format("'PCR/Nucleic Acid Test (NAT, NAAT, DNA)'")} AS TEST_PERFORMED_DESC,
 {_specimen(3)} AS WDRS_SPECIMEN_SOURCE, {_specimen(2)} AS SPECIMEN_SOURCE_SITE,
 {_specimen(1)} AS WDRS_SPECIMEN_TYPE, {_specimen(0)} AS SPECIMEN_TYPE,
 SpecimenDateCollected AS SPECIMEN_COLLECTION_DTTM, SpecimenDateReceived AS SPECIMEN_RECEIVED_DTTM,
 {SUBMITTER} AS SUBMITTER, CASE WHEN {SUBMITTER} = '27782022' THEN SubmitterName END AS SUBMITTER_OTHER,
 '81596' AS WDRS_PERFORMING_ORG, '81596' AS PERFORMING_LAB_ENTIRE_REPORT, {SUMMARY} AS WDRS_RESULT_SUMMARY
FROM raw""",
    "rostered": f"SELECT * EXCLUDE (match_found) FROM ({_ledger('1-URGENT')})",
    "no_match": f"SELECT * EXCLUDE (CASE_ID) FROM ({_ledger('2-HIGH')})",
    "review_ledger": f"SELECT * EXCLUDE (match_found) FROM ({_ledger('5-LOW')})",
    "sheets": "SELECT submission_number, CASE_ID FROM history WHERE priority = '5-LOW' AND match_found",
    "ref_people": f"""SELECT DISTINCT {_clean('FIRST_NAME')} AS f, {_clean('LAST_NAME')} AS l, BIRTH_DATE,
 SPECIMEN_COLLECTION_DTTM AS d, CASE_ID FROM registry WHERE SPECIMEN_COLLECTION_DTTM IS NOT NULL""",
    "case_mrns": """SELECT DISTINCT CASE_ID, MRN FROM (SELECT CASE_ID, unnest(coalesce(
 string_split(CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN, ', '), string_split(RESPNET_HOSPITALIZED_RHINO_MRN, ', '))) AS MRN
 FROM registry) WHERE MRN <> ''""",
    # whole-table linkage
    "all_src": _first_row("std", "submission_number", _without(FUZZY_INPUT, "submission_number"), FUZZY_INPUT),
    "all_people": _people("all_src", RAW_IDS),
    **_link_parts("all", "all_people", P_RAW_IDS),
    "all_candidates": "SELECT * FROM all_link WHERE bucket IN ('unmatched','no_demo') AND SubmitterPatientNumber <> ''",
    "all_ids": _ids("all_candidates"),
    # one run
    "several": _several("std", MULTI),
    "fresh": f"""SELECT *, submission_number IN (SELECT submission_number FROM several) AS qa_multiple_subtypes FROM std
WHERE submission_number NOT IN (SELECT submission_number FROM rostered)""",
    "checked": _flags("fresh"),
    "clean": "SELECT * FROM checked WHERE NOT qa_flag AND WDRS_RESULT_SUMMARY <> 'G_NEGATIVE' AND WDRS_RESULT <> 'G_FLU_ND'",
    "issues": f"""SELECT submission_number, internal_create_date, {STD}, qa_wdrs_result, qa_wdrs_result_summary,
 qa_multiple_subtypes, qa_missing_dob, qa_flag FROM checked
WHERE qa_flag AND WDRS_RESULT_SUMMARY IS DISTINCT FROM 'G_NEGATIVE'""",
    "to_link": _first_row("clean", "submission_number", _without(FUZZY_INPUT, "submission_number"), FUZZY_INPUT),
    "main_people": _people("to_link", RAW_IDS),
    **_link_parts("main", "main_people", P_RAW_IDS),
    "main_linked": f"""SELECT l.* EXCLUDE (PatientFirstName, PatientLastName, SubmitterPatientNumber), {STD}
FROM main_link l JOIN (SELECT submission_number, {STD} FROM clean) USING (submission_number)""",
    "main_candidates": "SELECT * FROM main_link WHERE bucket IN ('unmatched','no_demo') AND SubmitterPatientNumber <> ''",
    "main_ids": f"""SELECT DISTINCT submission_number, CASE_ID FROM ({_ids('main_candidates')}) JOIN case_mrns USING (MRN)""",
    "main_id_matched": _id_full("main_ids", "clean"),
    "main_matched": """SELECT * EXCLUDE (bucket) FROM main_linked WHERE bucket = 'exact'
UNION ALL BY NAME SELECT * FROM main_id_matched""",
    # rematch
    "open_no_match": "SELECT * FROM no_match WHERE match_found = FALSE",
    "open_left": "SELECT * FROM open_no_match WHERE submission_number NOT IN (SELECT submission_number FROM rostered)",
    "re_people": _first_row("open_left", "submission_number", "internal_create_date, " + PERSON,
                            "submission_number, internal_create_date, " + PERSON),
    **_link_parts("re", "re_people", "p.internal_create_date,"),
    "re_linked": f"SELECT l.*, {STD} FROM re_link l JOIN (SELECT submission_number, {STD} FROM open_left) USING (submission_number)",
    "re_raw": """SELECT DISTINCT submission_number, PatientFirstName, PatientLastName, SubmitterPatientNumber FROM raw
WHERE SubmitterPatientNumber <> '' AND submission_number IN (
 SELECT submission_number FROM re_link WHERE bucket IN ('unmatched','no_demo'))""",
    "re_ids": f"SELECT DISTINCT submission_number, CASE_ID FROM ({_ids('re_raw')}) JOIN case_mrns USING (MRN)",
    "re_id_matched": _id_full("re_ids", "open_left"),
    "re_matched": """SELECT * EXCLUDE (bucket) FROM re_linked WHERE bucket = 'exact'
UNION ALL BY NAME SELECT * FROM re_id_matched""",
    # review and rosters
    "sheet_merge": "SELECT r.* FROM review_ledger r JOIN (SELECT DISTINCT submission_number FROM sheets) USING (submission_number)",
    "reviewed": "SELECT * FROM sheet_merge WHERE submission_number NOT IN (SELECT submission_number FROM rostered)",
    "main_open": """SELECT * EXCLUDE (bucket) FROM main_linked WHERE bucket = 'unmatched'
 AND submission_number NOT IN (SELECT submission_number FROM main_id_matched)""",
    "ledger_roster": _roster("review_ledger"),
    "reviewed_roster": _dedup(f"({_roster('reviewed')})"),
    "run_matched": "SELECT * FROM main_matched UNION ALL BY NAME SELECT * FROM re_matched",
    "run_roster": f"""SELECT * FROM ({_dedup('(' + _roster('run_matched') + ')')}) UNION ALL SELECT * FROM reviewed_roster""",
    "resolved": """SELECT submission_number FROM re_linked WHERE bucket = 'fuzzy'
UNION SELECT submission_number FROM re_matched""",
    # forms
    "slots_long": f"""SELECT wdrs_case_id AS CaseID, variable, value
FROM form_records UNPIVOT INCLUDE NULLS (value FOR variable IN ({SLOT_NAMES}))""",
    "slots": """SELECT CaseID, CAST(regexp_extract(variable, '\\d+') AS INTEGER) AS lab_number,
 max(value) FILTER (WHERE variable LIKE 'tsttyp%') AS tsttyp, max(value) FILTER (WHERE variable LIKE 'poststdt%') AS poststdt,
 max(value) FILTER (WHERE variable LIKE 'tstres%') AS tstres, max(value) FILTER (WHERE variable LIKE 'hosplab%') AS hosplab
FROM slots_long GROUP BY ALL""",
    "free_slot": """SELECT CaseID, min(lab_number) AS first_empty_lab FROM slots
WHERE coalesce(hosplab,'') = '' AND coalesce(poststdt,'') = '' GROUP BY CaseID HAVING min(lab_number) <> 1""",
    **_form_parts("ledger", "ledger_roster"),
    **_form_parts("run", "run_roster"),
    "sheet": f"""{_first_row("(SELECT * FROM main_linked WHERE bucket = 'fuzzy' UNION ALL BY NAME SELECT * FROM re_linked WHERE bucket = 'fuzzy')",
        "submission_number", ', '.join(S.REVIEW_COLUMNS[1:]), ', '.join(S.REVIEW_COLUMNS))}""",
}


def with_parts(sql: str) -> str:
    """Prefix the parts a statement mentions, directly or through other parts."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_]+", text)):
            if word in PARTS and word not in needed:
                needed.add(word)
                visit(PARTS[word])

    visit(sql)
    ctes = ",\n".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def _by_key(name: str, rows: str, closed: str = "0", key: str = "submission_number") -> str:
    return f"""SELECT '{name}' AS name, CAST({key} AS VARCHAR) AS key, count(*) AS n, CAST({closed} AS BIGINT) AS closed
FROM {rows} x GROUP BY CAST({key} AS VARCHAR)"""


def _grown(table: str, *batches: str) -> str:
    """A ledger after batches have been appended, each without the keys that are there by then."""
    rows = f"SELECT submission_number, 0 AS step FROM {table}"
    for step, batch in enumerate(batches, 1):
        rows = f"""SELECT * FROM ({rows}) UNION ALL SELECT submission_number, {step} FROM {batch}
 WHERE submission_number NOT IN (SELECT submission_number FROM ({rows}))"""
    return f"({rows})"


def _soundex(name: str) -> str:
    """The sound of a name of the letters a to z: h and w are not heard, equal codes in a row count once."""
    code = f"translate({name}, 'abcdefghijklmnopqrstuvwxyz', '01230127022455012623017202')"
    heard = f"(substr({code}, 1, 1) || replace(substr({code}, 2), '7', ''))"
    for digit in "0123456":
        heard = f"regexp_replace({heard}, '{digit}+', '{digit}', 'g')"
    return f"upper(substr({name}, 1, 1)) || rpad(left(replace(substr({heard}, 2), '0', ''), 3), 3, '0')"


def _project(columns: str) -> str:
    return f"SELECT PHLAccessionNumber, {columns} FROM submissions"


def _absent(bucket: str, target: str, ledger: str) -> str:
    return f"""SELECT '{ledger}' AS ledger, submission_number, count(*) AS new_rows FROM {bucket} b
WHERE submission_number NOT IN (SELECT submission_number FROM {target}) GROUP BY submission_number"""


def _main(bucket: str) -> str:
    return f"(SELECT * FROM main_linked WHERE bucket = '{bucket}')"


def _true_pairs(swap: bool) -> str:
    ref = "rl || rf" if swap else "rf || rl"
    return f"""SELECT submission_number, h.CASE_ID, {_ratio('first_name_clean || last_name_clean', ref)}
FROM (SELECT DISTINCT submission_number, {PERSON} FROM ({_people('std')})) p JOIN history h USING (submission_number)
JOIN (SELECT CASE_ID, {_clean('FIRST_NAME')} AS rf, {_clean('LAST_NAME')} AS rl FROM wizard) w ON w.CASE_ID = h.CASE_ID
WHERE {COMPLETE}""".replace("\nFROM (SELECT DISTINCT", f" AS {'reverse_match_ratio' if swap else 'match_ratio'}\nFROM (SELECT DISTINCT", 1)


def _linked(bucket: str) -> str:
    return f"SELECT submission_number, {PERSON}, {MATCH} FROM all_link WHERE bucket = '{bucket}'"


_STATEMENTS = {
    "src_query": "SELECT SubmitterName, TestResult, count(*) AS analytes FROM submissions GROUP BY ALL",
    "src_submissions_since": """SELECT PHLAccessionNumber, SpecimenDateCollected, ResultTextConclusion FROM submissions
WHERE SpecimenDateCollected > DATE '1998-01-01'""",
    "src_cases_by_code": "SELECT * FROM registry_events WHERE CODE = 'FLUHP'",
    "ref_assemble": "SELECT * FROM registry",
    "src_review_csv": _first_row("review_ledger", "submission_number", ", ".join(S.CUMULATIVE_COLUMNS[1:]),
                                 ", ".join(S.CUMULATIVE_COLUMNS)),
    "src_ledger": f"SELECT {', '.join(S.NO_MATCH_COLUMNS)} FROM open_no_match",
    "raw_receipt": f"""SELECT PHLAccessionNumber AS submission_number, {DAY} AS internal_create_date,
 CAST(to_json(s) AS VARCHAR) AS raw_inbound_submission FROM submissions s""",
    "receipt_unnest": f"SELECT {', '.join(RAW)} FROM raw",
    "src_form_records": "SELECT * FROM form_records",
    "align_schema": f"""SELECT submission_number, internal_create_date, CAST(NULL AS BIGINT) AS CASE_ID,
 {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in ('first_name_clean','last_name_clean','first_name_clean_right','last_name_clean_right'))},
 {', '.join(f'CAST(NULL AS DATE) AS {c}' for c in ('submitted_dob','submitted_collection_date','reference_collection_date'))},
 CAST(NULL AS BIGINT) AS business_day_count, CAST(NULL AS DOUBLE) AS match_ratio, CAST(NULL AS DOUBLE) AS reverse_match_ratio,
 {STD} FROM std""",
    "insert_if_absent": f"""SELECT submission_number, internal_create_date, CASE_ID, first_name_clean, last_name_clean,
 CAST(NULL AS VARCHAR) AS first_name_clean_right, CAST(NULL AS VARCHAR) AS last_name_clean_right, submitted_dob,
 submitted_collection_date, reference_collection_date, CAST(NULL AS BIGINT) AS business_day_count,
 CAST(NULL AS DOUBLE) AS match_ratio, CAST(NULL AS DOUBLE) AS reverse_match_ratio, {STD}
FROM (SELECT * FROM rostered UNION ALL BY NAME SELECT submission_number, internal_create_date, {STD} FROM std
 WHERE submission_number NOT IN (SELECT submission_number FROM rostered))""",
    "route_outputs": " UNION ALL ".join([
        _absent("issues", "rostered", "qa_tbl"), _absent("raw", "rostered", "received_submissions"),
        _absent("main_open", "no_match", "no_match_tbl"),
        _absent("main_open", "rostered", "fuzzy_matched_none_tbl"),
        _absent(_main("fuzzy"), "review_ledger", "fuzzy_matched_review_tbl"),
        _absent("main_id_matched", "rostered", "id_matched"),
        """SELECT 'rostered_tbl' AS ledger, submission_number, count(*) AS new_rows FROM (
 SELECT submission_number FROM main_matched WHERE submission_number NOT IN (SELECT submission_number FROM rostered)
 UNION ALL SELECT submission_number FROM reviewed WHERE submission_number NOT IN (SELECT submission_number FROM rostered)
  AND submission_number NOT IN (SELECT submission_number FROM main_matched)) GROUP BY submission_number""",
        _absent(_main("no_demo"), "rostered", "fuzzy_without_demo_tbl"),
    ]),
    "route_outputs_catalog": " UNION ALL ".join([
        _absent("issues", "rostered", "qa_tbl_resp"), _absent("raw", "rostered", "received_submissions_resp"),
        _absent("main_open", "no_match", "unmatched_resp"),
        _absent(_main("fuzzy"), "rostered", "fuzzy_matched_resp"),
        _absent(_main("no_demo"), "rostered", "no_demo_resp"),
        _absent(_main("exact"), "rostered", "exact_matched_resp"),
    ]),
    "flag_resolved": """SELECT submission_number, WDRS_RESULT, SPECIMEN_TYPE,
 match_found OR submission_number IN (SELECT submission_number FROM resolved) AS match_found FROM no_match""",
    "review_sheet": "SELECT *, FALSE AS good_match, FALSE AS resolved, CAST(NULL AS VARCHAR) AS notes FROM sheet",
    "roster_csv": f"""SELECT * REPLACE ({', '.join(f"strftime({c}, '%m/%d/%Y') AS {c}" for c in (
        'DOB', 'SPECIMEN_COLLECTION_DTTM', 'SPECIMEN_RECEIVED_DTTM'))}) FROM ledger_roster""",
    "rematch_out": f"""SELECT 'fuzzy_matched_review_tbl' AS ledger, submission_number, CASE_ID, {STD} FROM re_linked
WHERE bucket = 'fuzzy' AND submission_number NOT IN (SELECT submission_number FROM review_ledger)
UNION ALL SELECT 'fuzzy_matched_roster_tbl', submission_number, CASE_ID, {STD} FROM re_linked
WHERE bucket = 'exact' AND submission_number NOT IN (SELECT submission_number FROM rostered)""",
    "cumulative_roster": _first_row("rostered", "submission_number", ", ".join(S.CUMULATIVE_COLUMNS[1:]),
                                    ", ".join(S.CUMULATIVE_COLUMNS)),
    "review_archive": "SELECT * FROM sheets",
    "form_updates_json": "SELECT wdrs_case_id, CAST(to_json(u) AS VARCHAR) AS record FROM ledger_form_updates u",
    "performing_lab": _project("'81596' AS PERFORMING_LAB_ENTIRE_REPORT"),
    "submitting_lab": _project(f"SubmitterName, {SUBMITTER} AS SUBMITTER"),
    "submitter_other": _project(
        f"SubmitterName, CASE WHEN contains({SUBMITTER}, '27782022') THEN SubmitterName END AS SUBMITTER_OTHER"),
    "specimen_type": _project(f"SpecimenSource, {_specimen(0)} AS SPECIMEN_TYPE"),
    "wdrs_specimen_type": _project(f"SpecimenSource, {_specimen(1)} AS WDRS_SPECIMEN_TYPE"),
    "specimen_source_site": _project(f"SpecimenSource, {_specimen(2)} AS SPECIMEN_SOURCE_SITE"),
    "wdrs_specimen_source": _project(f"SpecimenSource, {_specimen(3)} AS WDRS_SPECIMEN_SOURCE"),
    "wdrs_test_performed": _project(f"ResultTextConclusion, {TEST.format(_q('G_PCR'))} AS WDRS_TEST_PERFORMED"),
    "test_performed_desc": _project(
        f"ResultTextConclusion, {TEST.format(_q('PCR/Nucleic Acid Test (NAT, NAAT, DNA)'))} AS TEST_PERFORMED_DESC"),
    "wdrs_result": _project(f"ResultTextConclusion, {RESULT} AS WDRS_RESULT"),
    "test_result": _project(f"ResultTextConclusion, {LABEL} AS TEST_RESULT"),
    "result_summary": _project(f"TestResult, {SUMMARY} AS WDRS_RESULT_SUMMARY"),
    "name_clean": _project(
        f"{_clean('PatientFirstName')} AS first_name_clean, {_clean('PatientLastName')} AS last_name_clean"),
    "id_routing_flag": _project("""PatientFirstName, PatientLastName, coalesce(regexp_matches(PatientFirstName, '\\d'), FALSE)
 OR coalesce(regexp_matches(PatientLastName, '\\d'), FALSE) AS send_to_id_matching"""),
    "date_cast": _project("SpecimenDateReceived, CAST(SpecimenDateReceived AS DATE) AS received_day"),
    "roster_note": _project(
        f"'Updated event via GCD RESPNET Lab Result (add lab) roster on {RUN_DATE} from PHL subtyping' AS note"),
    "parse_date": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
    "alt_source_result": f"SELECT l_orderkey, l_linenumber, {_rules('text', ALT, 1)} AS WDRS_RESULT FROM alt_results",
    "alt_source_test_result": f"SELECT l_orderkey, l_linenumber, {_rules('text', ALT, 2)} AS TEST_RESULT FROM alt_results",
    "standardize": f"SELECT submission_number, PatientBirthDate, {STD} FROM std",
    "form_test_code": f"SELECT submission_number, {FORM_TEST} AS form_test FROM std",
    "form_result_code": f"SELECT submission_number, WDRS_RESULT, {FORM_RESULT} AS form_result FROM std",
    "split_field_slot": """SELECT CaseID, variable, regexp_extract(variable, '[a-zA-Z]+') AS field,
 CAST(regexp_extract(variable, '\\d+') AS INTEGER) AS lab_number FROM slots_long""",
    "key_as_string": "SELECT CAST(CASE_ID AS VARCHAR) AS CASE_ID, RESPNET_CASE_ID FROM registry",
    "column_selectors": """SELECT submission_number, qa_multiple_subtypes, qa_wdrs_result, qa_wdrs_result_summary,
 qa_missing_dob, qa_flag, SPECIMEN_COLLECTION_DTTM, SPECIMEN_RECEIVED_DTTM FROM checked""",
    "qa_test_performed": "SELECT submission_number, WDRS_TEST_PERFORMED IS NULL AS qa_wdrs_test_performed FROM std",
    "qa_test_desc": "SELECT submission_number, TEST_PERFORMED_DESC IS NULL AS qa_test_performed_desc FROM std",
    "qa_result": f"""SELECT submission_number, (WDRS_RESULT NOT IN ({ACCEPTED}) OR WDRS_RESULT IS NULL) AS qa_wdrs_result FROM std""",
    "qa_result_summary": """SELECT submission_number, WDRS_RESULT_SUMMARY IS NULL
 OR WDRS_RESULT_SUMMARY NOT IN ('G_POSITIVE','G_NEGATIVE') AS qa_wdrs_result_summary FROM std""",
    "qa_missing_dob": f"SELECT submission_number, qa_missing_dob FROM ({_flags('(SELECT *, FALSE AS qa_multiple_subtypes FROM std)')})",
    "qa_missing_dob_strict": "SELECT submission_number, FALSE AS qa_missing_dob FROM std",
    "qa_flag": f"""SELECT submission_number, qa_wdrs_result, qa_wdrs_result_summary, qa_missing_dob, qa_flag
FROM ({_flags('(SELECT *, FALSE AS qa_multiple_subtypes FROM std)')})""",
    "clean_split": f"SELECT submission_number, {STD} FROM clean",
    "issue_split": "SELECT * FROM issues",
    "positive_only": """SELECT submission_number, WDRS_RESULT, WDRS_RESULT_SUMMARY FROM std
WHERE contains(WDRS_RESULT_SUMMARY,'G_POSITIVE') AND WDRS_RESULT <> 'RP'""",
    "has_mrn": "SELECT PHLAccessionNumber, SubmitterPatientNumber FROM submissions WHERE SubmitterPatientNumber <> ''",
    "looks_like_id": _ids("raw"),
    "key_present": "SELECT CASE_ID, SPECIMEN_COLLECTION_DTTM FROM registry WHERE SPECIMEN_COLLECTION_DTTM IS NOT NULL",
    "non_empty_input": "SELECT count(*) > 0 AS has_rows, FALSE AS empty_has_rows FROM submissions",
    "fuzzy_projection": f"SELECT {FUZZY_INPUT} FROM to_link",
    "qa_multiple_subtypes": f"SELECT submission_number, TRUE AS qa_multiple_subtypes, {STD} FROM std WHERE submission_number IN (SELECT submission_number FROM several)",
    "qa_multiple_subtypes_v1": f"""SELECT submission_number, TRUE AS qa_multiple_subtypes, {STD} FROM std
WHERE submission_number IN (SELECT submission_number FROM ({_several('std', '''NOT (contains(WDRS_RESULT_SUMMARY,'G_POS') AND contains(TEST_RESULT,'RP'))
 AND NOT regexp_matches(WDRS_RESULT,'G_FLU_A_D|G_FLU_B') AND contains(WDRS_RESULT,'G_')''')}))""",
    "sort_by_count": "SELECT submission_number, n AS count FROM several",
    "ref_join": """SELECT w.CASE_ID, count(v.SPECIMEN__COLLECTION__DTTM) AS labs, max(v.SPECIMEN__COLLECTION__DTTM) AS last_lab
FROM wizard w LEFT JOIN investigation v ON w.CASE_ID = v.CASE_ID GROUP BY w.CASE_ID""",
    "not_yet_rostered": f"SELECT submission_number, {STD} FROM std WHERE submission_number NOT IN (SELECT submission_number FROM rostered)",
    "not_yet_rostered_by_date": f"""SELECT submission_number, {STD} FROM std s WHERE NOT EXISTS (SELECT 1 FROM rostered r
WHERE r.submission_number = s.submission_number AND r.submitted_collection_date = s.SPECIMEN_COLLECTION_DTTM)""",
    "semi_flag": """SELECT submission_number, WDRS_RESULT,
 submission_number IN (SELECT submission_number FROM several) AS qa_multiple_subtypes FROM std""",
    "attach_original": f"SELECT bucket, {', '.join(S.REVIEW_COLUMNS)}, {STD} FROM main_linked",
    "mrn_join": f"""SELECT DISTINCT submission_number, MRN, CASE_ID FROM ({_ids('raw')}) JOIN case_mrns USING (MRN)""",
    "mrn_recover": """SELECT DISTINCT submission_number, PatientFirstName, PatientLastName, SubmitterPatientNumber FROM raw
WHERE SubmitterPatientNumber <> '' AND submission_number IN (SELECT submission_number FROM no_match)""",
    "review_merge": "SELECT * FROM sheet_merge",
    "roster_enrich": """SELECT DISTINCT m.CASE_ID AS CaseID, WDRS_PERFORMING_ORG, m.SPECIMEN_COLLECTION_DTTM, SPECIMEN_RECEIVED_DTTM,
 WDRS_SPECIMEN_TYPE, WDRS_SPECIMEN_SOURCE, WDRS_TEST_PERFORMED, WDRS_RESULT, WDRS_RESULT_SUMMARY, SUBMITTER, SUBMITTER_OTHER,
 EXTERNAL_ID AS PARTY_EXTERNAL_ID, FIRST_NAME, MIDDLE_NAME, LAST_NAME, BIRTH_DATE AS DOB
FROM review_ledger m LEFT JOIN registry r ON m.CASE_ID = r.CASE_ID""",
    "roster_vs_registry": f"SELECT {ROSTER_KEY} FROM ({_dedup('(' + _roster('rostered') + ')')})",
    "form_join": "SELECT * FROM ledger_form_rows",
    "anti_insert": """SELECT submission_number, WDRS_RESULT, TEST_RESULT FROM no_match
WHERE submission_number NOT IN (SELECT submission_number FROM rostered)""",
    "demographic_link": f"SELECT submission_number, {PERSON}, {MATCH}, bucket FROM all_link",
    "no_demo_split": f"SELECT DISTINCT submission_number, {PERSON} FROM ({_people('std')}) WHERE ({COMPLETE}) IS NOT TRUE",
    "candidate_block": f"""SELECT DISTINCT {PERSON}, min(CASE_ID) AS CASE_ID, first_name_clean_right, last_name_clean_right,
 reference_collection_date, business_day_count, match_ratio, reverse_match_ratio
FROM all_good JOIN all_people USING (submission_number) GROUP BY ALL""",
    "business_day_count": f"""SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate,
 {_weekdays('CAST(o_orderdate AS DATE)', 'CAST(l_shipdate AS DATE)')} AS business_day_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "match_ratio": _true_pairs(False),
    "reverse_match_ratio": _true_pairs(True),
    "exact_link": _linked("exact"),
    "fuzzy_link": _linked("fuzzy"),
    "unmatched": _linked("unmatched"),
    "best_match": f"SELECT DISTINCT {PERSON}, {MATCH} FROM all_link WHERE bucket IN ('exact','fuzzy')",
    "triage_counts": "SELECT bucket, count(*) AS submissions FROM all_link GROUP BY bucket",
    "triage_by_result": """SELECT WDRS_RESULT, bucket, count(*) AS analytes, count(DISTINCT submission_number) AS submissions
FROM all_link JOIN (SELECT submission_number, WDRS_RESULT FROM std) USING (submission_number) GROUP BY ALL""",
    "mrn_explode": """SELECT CASE_ID, CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN,
 unnest(coalesce(string_split(RESPNET_HOSPITALIZED_RHINO_MRN, ', '), [NULL])) AS RESPNET_HOSPITALIZED_RHINO_MRN FROM (
 SELECT CASE_ID, unnest(coalesce(string_split(CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN, ', '), [NULL]))
  AS CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN, RESPNET_HOSPITALIZED_RHINO_MRN FROM registry)""",
    "mrn_pick": """SELECT CASE_ID, MRN FROM (SELECT CASE_ID, CASE WHEN m1 IS NOT NULL THEN m1 ELSE m2 END AS MRN FROM (
 SELECT CASE_ID, m1, unnest(coalesce(string_split(RESPNET_HOSPITALIZED_RHINO_MRN, ', '), [NULL])) AS m2 FROM (
  SELECT CASE_ID, unnest(coalesce(string_split(CDC_N_COV_2019_HOSPITALIZED_RESPNET_MRN, ', '), [NULL])) AS m1,
   RESPNET_HOSPITALIZED_RHINO_MRN FROM wizard))) WHERE MRN IS NOT NULL""",
    "mrn_candidates": "SELECT submission_number, PatientFirstName, PatientLastName, SubmitterPatientNumber FROM all_candidates",
    "id_unpivot": "SELECT * FROM all_ids",
    "mrn_link": "SELECT DISTINCT submission_number, CASE_ID FROM all_ids JOIN case_mrns USING (MRN)",
    "id_matched_full": "SELECT * FROM main_id_matched",
    "first_empty_slot": "SELECT * FROM free_slot",
    "slot_pivot": "SELECT * FROM slots",
    "bucket_counts": "SELECT bucket, count(*) AS analytes, count(DISTINCT submission_number) AS submissions FROM main_linked GROUP BY bucket",
    "keep_one_per_key": _first_row("std", "submission_number", STD, f"submission_number, {STD}"),
    "distinct_rows": "SELECT DISTINCT SUBMITTER, WDRS_RESULT, WDRS_RESULT_SUMMARY, SPECIMEN_TYPE, TEST_PERFORMED_DESC FROM std",
    "roster_unique": _first_row(
        "(SELECT CASE_ID AS CaseID, * FROM review_ledger WHERE contains(WDRS_RESULT_SUMMARY,'G_POSITIVE') AND WDRS_RESULT <> 'RP')",
        ROSTER_KEY, "SUBMITTER, WDRS_SPECIMEN_TYPE", f"{ROSTER_KEY}, SUBMITTER, WDRS_SPECIMEN_TYPE"),
    "union_all": f"SELECT submission_number, {PERSON} FROM all_link WHERE bucket IN ('unmatched','no_demo')",
    "union_diagonal": """SELECT submission_number, CASE_ID, WDRS_RESULT, first_name_clean, CAST(NULL AS BOOLEAN) AS match_found FROM rostered
UNION ALL SELECT submission_number, NULL, WDRS_RESULT, NULL, match_found FROM no_match""",
    "union_rosters": "SELECT * FROM run_roster",
    "form_unpivot": "SELECT * FROM slots_long",
    "slot_fill": f"SELECT CaseID, {SLOT_NAMES} FROM ledger_form_filled",
    "form_updates": "SELECT * FROM ledger_form_updates",
    "pull": f"SELECT {', '.join(RAW)} FROM raw",
    "wrangle": f"""SELECT submission_number, {STD}, 'clean' AS part FROM clean
UNION ALL SELECT submission_number, {STD}, 'issues' AS part FROM issues""",
    "match": "SELECT DISTINCT * FROM main_matched",
    "rematch": "SELECT DISTINCT * FROM re_matched",
    "create_roster": "SELECT * FROM ledger_roster",
    "dedup_roster": _dedup("ledger_roster"),
    "dedup_roster_row_wise": f"""SELECT DISTINCT {', '.join('x."' + c + '"' for c in S.ROSTER_COLUMNS)}
FROM ledger_roster x LEFT JOIN registry g ON g.CASE_ID = x.CaseID
WHERE NOT coalesce({_strip('x.TEST_RESULT')} = {_strip('g.WDRS__RESULT')}
 AND x.SPECIMEN_COLLECTION_DTTM = g.SPECIMEN_COLLECTION_DTTM, FALSE)""",
    "reviewed_roster": "SELECT * FROM reviewed_roster",
    "combine_and_write": " UNION ALL ".join([_by_key(name, rows) for name, rows in {
        "received_submissions": "raw", "qa_tbl": "issues", "fuzzy_matched_none_tbl": "main_open",
        "fuzzy_matched_review_tbl": _grown("review_ledger", _main("fuzzy"), "(SELECT * FROM re_linked WHERE bucket = 'fuzzy')"),
        "fuzzy_without_demo_tbl": _main("no_demo"), "id_matched": "main_id_matched",
        "fuzzy_matched_roster_tbl": "(SELECT * FROM re_linked WHERE bucket = 'exact')",
        "rostered_tbl": _grown("rostered", "main_matched", "reviewed"), "manual_review_resp": "sheet"}.items()] + [
        _by_key("no_match_tbl", """(SELECT submission_number, CASE WHEN match_found THEN TRUE WHEN match_found IS NULL THEN NULL
 ELSE submission_number IN (SELECT submission_number FROM resolved) END AS match_found
 FROM (SELECT submission_number, match_found FROM no_match UNION ALL SELECT submission_number, FALSE FROM main_open
  WHERE submission_number NOT IN (SELECT submission_number FROM no_match)))""", "count(*) FILTER (match_found)")]),
    "run": " UNION ALL ".join([_by_key(kind, part) for kind, part in {
        "qa_issues": "issues", "received": "raw", "unmatched": "main_open", "fuzzy": _main("fuzzy"),
        "exact": _main("exact"), "id_matched": "main_id_matched", "combined_roster": "main_matched",
        "reviewed": "reviewed", "no_demo": _main("no_demo"), "review_sheet": "sheet",
        "resolved": "resolved"}.items()] + [
        _by_key("roster", "run_roster", key="CaseID"), _by_key("form_updates", "run_form_updates", key="wdrs_case_id")]),
    "receipt_variant": """SELECT * REPLACE (
 CASE WHEN NOT regexp_matches(PHLAccessionNumber, '[02468]$') THEN SubmitterName END AS SubmitterName,
 CASE WHEN regexp_matches(PHLAccessionNumber, '[02468]$') THEN SpecimenSource END AS SpecimenSource) FROM raw""",
    # incremental work gives what doing all of it anew would
    "rematch_delta": f"""SELECT DISTINCT {', '.join('p.' + c.strip() for c in PERSON.split(','))}, {MATCH}, b.bucket
FROM re_people p JOIN re_best b USING (submission_number)
WHERE submission_number NOT IN (SELECT submission_number FROM re_good WHERE CASE_ID % 2 = 0)""",
    "ledger_resolve": f"""SELECT {', '.join(S.NO_MATCH_COLUMNS[:-1])},
 match_found OR submission_number LIKE '%3' OR submission_number LIKE '%8' AS match_found FROM no_match""",
    "cumulative_snapshot": _first_row("rostered", "submission_number", ", ".join(S.CUMULATIVE_COLUMNS[1:]),
                                      ", ".join(S.CUMULATIVE_COLUMNS)),
    "src_review_rejects": f"""SELECT submission_number, submission_number LIKE '%7' AND submitted_dob IS NOT NULL AS rejected,
 CASE WHEN submission_number NOT LIKE '%7' THEN submitted_dob END AS submitted_dob FROM ({_first_row(
        "review_ledger", "submission_number", ", ".join(S.CUMULATIVE_COLUMNS[1:]), ", ".join(S.CUMULATIVE_COLUMNS))})""",
    "birth_date_slips": f"""SELECT p.first_name_clean, p.last_name_clean, submitted_dob, submitted_collection_date,
 r.f AS first_name_clean_right, r.l AS last_name_clean_right, r.d AS reference_collection_date, r.CASE_ID
FROM (SELECT DISTINCT first_name_clean, last_name_clean, submitted_collection_date,
 CASE WHEN day(submitted_dob) <= 12 THEN make_date(year(submitted_dob), day(submitted_dob), month(submitted_dob))
 ELSE submitted_dob + 1 END AS submitted_dob FROM all_people WHERE {COMPLETE}) p
JOIN (SELECT f, l, BIRTH_DATE AS b, d, min(CASE_ID) AS CASE_ID FROM ref_people GROUP BY ALL) r ON last_name_clean = l AND {_soundex('first_name_clean')} = {_soundex('f')}
WHERE abs(submitted_collection_date - d) <= 5 AND {_ratio('first_name_clean || last_name_clean', 'f || l')} >= 80
 AND (hamming(strftime(submitted_dob, '%Y%m%d'), strftime(b, '%Y%m%d')) = 1
  OR (submitted_dob <> b AND year(submitted_dob) = year(b) AND month(submitted_dob) = day(b) AND day(submitted_dob) = month(b)))""",
}

ORACLES = {name: with_parts(sql) for name, sql in _STATEMENTS.items()}
