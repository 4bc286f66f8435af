"""Run configuration and the default influenza tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Codes, labels, patterns and column lists that results must
# carry exactly.
# --------------------------------------------------------------------------

PERFORMING_LAB_CODE = "81596"
OTHER_SUBMITTER_CODE = "27782022"
DEFAULT_CASE_CODE = "FLUHP"
FORM_LAB_NAME = "WAPHL"
ROSTER_NOTE = (
    "Updated event via GCD RESPNET Lab Result (add lab) roster on {run_date} from PHL subtyping"
)

SUBMITTER_CODES = {
    "Cascade Valley Hospital": "80887",
    "Evergreen Health - Kirkland": "81993",
    "Harborview Medical Center": "82558",
    "Kaiser Permanente - Seattle": "2752312620",
    "Labcorp - Seattle Cherry Hill": "6130705570",
    "Laboratories Northwest": "87774",
    "Multicare Deaconess Hospital": "81546",
    "Overlake Hospital Medical Center": "84674",
    "Peace Hlth Lab SWMC - Vancouver": "85289",
    "Providence - Sacred Heart Medical Center": "85820",
    "Providence Everett Med Ctr Colby Campus": "85742",
    "Everett Clinic Laboratory": "85742",
    "Providence Reg Med Ctr - Everett": "85742",
    "Seattle Childrens Hosp": "86719",
    "Skagit Valley Reg. Med Center / Hospital": "6861256992",
    "St Francis Hospital Lab": "87277",
    "St Joseph Medical Center, Tacoma": "87300",
    "Swedish Hospital - Edmonds": "87489",
    "University of Washington Medical Center": "88215",
    "Valley Medical Center": "88319",
    "Kadlec Regional Medical Center": "83089",
    "Virginia Mason Medical Center": "88415",
}

# specimen text -> (type label, type code, source-site label, source code)
SPECIMENS = {
    "Nasal Swabs": ("Swab-nasal", "G_SWAB_NASAL", "Nose", "G_NOSE"),
    "Respiratory: nasal swab": ("Swab-nasal", "G_SWAB_NASAL", "Nose", "G_NOSE"),
    "Respiratory: nasal wash": (None, None, "Nose", "G_NOSE"),
    "Nasopharyngeal Swab (NP)": (
        "Swab-nasopharyngeal (NP)", "G_SWAB-NP", "Nasopharyngeal (NP) swab", "G_NP_SWAB"),
    "Respiratory: NP swab": (
        "Swab-nasopharyngeal (NP)", "G_SWAB-NP", "Nasopharyngeal (NP) swab", "G_NP_SWAB"),
    "Oropharyngeal Swab": (
        "Swab-oropharyngeal (OP)", "G_SWAB-OP", "Oropharynx", "G_OROPHARYNX"),
    "Conjunctival Swab": (None, None, "Eye", "G_EYE"),
    "Conjunctival swab": (None, None, "Eye", "G_EYE"),
    "Sputum": ("Sputum", "G_SPUTUM", "Sputum", "G_SPUTUM"),
}

# ordered (pattern, code, label); the first pattern found in the text decides
RESULT_RULES = [
    ("None|60|61|62|50|68|66", "G_FLU_ND", "Influenza not detected"),
    (r"Influenza A\(2009 H1N1\) virus detected by RT-PCR",
     "G_FLU_A_(09_PDM_H1N1)_D", "Influenza A (09 Pdm H1N1) detected"),
    (r"Influenza A\(H3\) virus detected by RT-PCR",
     "G_FLU_A_(H3)_D", "Influenza A (H3) detected"),
    (r"Influenza A\(H5\) virus detected by RT-PCR",
     "G_FLU_A_(H5)_D", "Influenza A (H5) detected"),
    (r"Influenza A\(H7\) virus detected by RT-PCR",
     "G_FLU_A_(H7)_D", "Influenza A (H7) detected"),
    ("Influenza A virus detected by RT-PCR", "G_FLU_A_D", "Influenza A detected"),
    ("Influenza B/Victoria lineage detected by RT-PCR",
     "G_FLU_B_(VICTORIA)_D", "Influenza B (Victoria) detected"),
    ("Influenza B/Yamagata lineage detected by RT-PCR",
     "G_FLU_B_(YAMAGATA)_D", "Influenza B (Yamagata) detected"),
    ("Influenza B virus detected by RT-PCR", "G_FLU_B", "Influenza B detected"),
]

# the second laboratory words three results differently
ALT_RESULT_PATTERNS = {
    "G_FLU_A_(09_PDM_H1N1)_D": "Influenza A H1N1 detected",
    "G_FLU_A_(H3)_D": "Influenza A H3N2 detected",
    "G_FLU_B": "Influenza B detected",
}

NOT_DETECTED_CODE = "G_FLU_ND"
POSITIVE, NEGATIVE = "G_POSITIVE", "G_NEGATIVE"
POSITIVE_MARK, NEGATIVE_MARK = "51", "52"
CONTROL_RESULT = "RP"
TEST_EXCLUDE_PATTERN, TEST_PCR_PATTERN = "51|INCONCLUSIVE", "RT-PCR"
TEST_PCR_CODE, TEST_PCR_LABEL = "G_PCR", "PCR/Nucleic Acid Test (NAT, NAAT, DNA)"

SUBTYPE_CODES = [
    "G_FLU_A_(09_PDM_H1N1)_D", "G_FLU_A_(H3)_D", "G_FLU_A_(H5)_D", "G_FLU_A_(H7)_D",
    "G_FLU_B_(VICTORIA)_D", "G_FLU_B_(YAMAGATA)_D",
]
ACCEPTED_RESULTS = [code for _, code, _ in RESULT_RULES] + [CONTROL_RESULT]

FORM_TEST_CODES = {
    "G_PCR": 2, "G_RAPID_TEST_EIA": 1, "G_VIRAL_CULTURE": 3, "G_DFA_IHC": 5, "G_OTHER": 6,
}
FORM_RESULT_CODES = {
    "G_FLU_A_(09_PDM_H1N1)_D": 5, "G_FLU_A_(H3)_D": 8, "G_FLU_A_(H3N2)_D": 12,
    "G_FLU_A_(H5)_D": 11, "G_FLU_A_(H7)_D": 11, "G_FLU_A_D": 1, "G_FLU_A_OTHER_D": 1,
    "G_FLU_B_(VICTORIA)_D": 14, "G_FLU_B_(YAMAGATA)_D": 13, "G_FLU_B_D": 2,
    "G_FLU_B_OTHER_D": 2, "G_FLU_A/B": 4, "G_OTHER": 11,
}
# our rule table yields G_FLU_B, which the form map above does not list
FORM_RESULT_ADDITIONS = {"G_FLU_B": 2}
FORM_SLOTS = 4
FORM_FIELDS = ["tsttyp", "poststdt", "tstres", "hosplab"]

DATE_PATTERNS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
]
EXCEL_EPOCH = "1899-12-30"

STANDARD_COLUMNS = [
    "WDRS_RESULT", "WDRS_TEST_PERFORMED", "WDRS_SPECIMEN_SOURCE", "WDRS_SPECIMEN_TYPE",
    "SPECIMEN_TYPE", "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "SUBMITTER",
    "SUBMITTER_OTHER", "WDRS_PERFORMING_ORG", "WDRS_RESULT_SUMMARY", "SPECIMEN_SOURCE_SITE",
    "PERFORMING_LAB_ENTIRE_REPORT", "TEST_PERFORMED_DESC", "TEST_RESULT",
]
REVIEW_COLUMNS = [
    "submission_number", "internal_create_date", "CASE_ID", "first_name_clean",
    "last_name_clean", "first_name_clean_right", "last_name_clean_right", "submitted_dob",
    "submitted_collection_date", "reference_collection_date", "business_day_count",
    "match_ratio", "reverse_match_ratio",
]
CUMULATIVE_COLUMNS = [
    "submission_number", "internal_create_date", "first_name_clean", "last_name_clean",
    "submitted_dob", "submitted_collection_date", "reference_collection_date", "CASE_ID",
]
FUZZY_INPUT_COLUMNS = [
    "submission_number", "internal_create_date", "PatientFirstName", "PatientLastName",
    "PatientBirthDate", "SpecimenDateCollected", "SpecimenDateReceived",
    "SubmitterPatientNumber",
]
ROSTER_KEY = [
    "CaseID", "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "WDRS_RESULT",
    "WDRS_RESULT_SUMMARY",
]
ROSTER_COLUMNS = [
    "CaseID", "CODE", "PARTY_EXTERNAL_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "SUFFIX",
    "DOB", "SSN", "GENDER", "PHONE", "STREET1", "CITY", "STATE", "POSTAL_CODE",
    "ContactPointCounty", "REPORTING_COUNTY", "RACE_AMERICAN_INDIAN_OR_ALASKA_NATIVE",
    "RACE_ASIAN", "RACE_BLACK_OR_AFRICAN_AMERICAN",
    "RACE_NATIVE_HAWAIIAN_OR_OTHER_PACIFIC_ISLANDER", "RACE_WHITE", "RACE_OTHER_RACE",
    "RACE_OTHER_RACE_SPECIFY", "RACE_DECLINED", "RACE_UNKNOWN", "RACE_AI_OR_AN",
    "RACE_NH_OR_PI", "RACE_EXTENDED", "ETHNICITY", "LANGUAGE", "LANGUAGE_OTHER_SPECIFY",
    "PERFORMING_LAB_ENTIRE_REPORT", "PERFORMING_LAB_ENTIRE_REPORT_OTHER", "WDRS_LAB_RACE",
    "WDRS_LAB_RACE_SPECIFY", "WDRS_LAB_ETHNICITY", "ORDERING_PROVIDER", "ORDERING_FACILITY",
    "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "SPECIMEN_ID_ACCESSION_NUM_MANUAL",
    "WDRS_SPECIMEN_TYPE", "SPECIMEN_TYPE", "WDRS_SPECIMEN_SOURCE", "SPECIMEN_SOURCE_SITE",
    "WDRS_TEST_PERFORMED", "TEST_PERFORMED_DESC", "WDRS_RESULT", "TEST_RESULT",
    "WDRS_RESULT_SUMMARY", "SUBMITTER", "SUBMITTER_OTHER", "USER_LAB_REPORT_NOTE", "Case.Note",
]
# roster columns that are always the empty string
ROSTER_BLANKS = ["SPECIMEN_TYPE", "SPECIMEN_SOURCE_SITE", "TEST_PERFORMED_DESC", "TEST_RESULT"]

# --------------------------------------------------------------------------
# Ledger schemas (the end of the fixed values)
# --------------------------------------------------------------------------

_DATE_COLUMNS = {
    "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM", "internal_create_date",
    "submitted_dob", "submitted_collection_date", "reference_collection_date", "DOB",
}
_OTHER_TYPES = {
    "CASE_ID": "bigint", "CaseID": "bigint", "business_day_count": "bigint", "match_ratio": "double",
    "reverse_match_ratio": "double", "match_found": "boolean", "good_match": "boolean",
    "resolved": "boolean",
}


def _column_type(name: str) -> str:
    if name in _DATE_COLUMNS:
        return "date"
    return "boolean" if name.startswith("qa_") else _OTHER_TYPES.get(name, "string")


def schema_for(columns: list[str]) -> str:
    """DDL for ledger columns, typed by name."""
    return ", ".join(f"`{name}` {_column_type(name)}" for name in columns)


_KEY = ["submission_number", "internal_create_date"]
_LINKED = REVIEW_COLUMNS + STANDARD_COLUMNS
_QA_FLAGS = [
    "qa_wdrs_result", "qa_wdrs_result_summary", "qa_multiple_subtypes", "qa_missing_dob", "qa_flag",
]
NO_MATCH_COLUMNS = _KEY + [
    "submitted_dob", "submitted_collection_date", "reference_collection_date",
    "first_name_clean", "last_name_clean",
] + STANDARD_COLUMNS + ["match_found"]

#: What earlier runs have compared, for retries against what is new.
COMPARED_SCHEMAS = {
    "compared_persons": "rule string, first_name_clean string, last_name_clean string, submitted_dob date, "
                        "submitted_collection_date date",
    "compared_people": "rule string, first_name_clean_right string, last_name_clean_right string, ref_dob date, "
                       "reference_collection_date date, CASE_ID bigint, last_case_id bigint",
    "compared_numbers": "CASE_ID bigint, MRN string",
    "compared_candidates": "submission_number string, MRN string",
}
#: The cumulative roster as the last run left it.
CUMULATIVE = "cumulative_roster_snapshot"
KEPT_SCHEMAS = COMPARED_SCHEMAS | {CUMULATIVE: schema_for(CUMULATIVE_COLUMNS) + ", through int"}
#: Tables whose rows are open until this flag is set.
MATCH_FLAG = "match_found"
FLAGGED_TABLES = ("no_match_tbl", "unmatched_resp")

LEDGER_SCHEMAS = KEPT_SCHEMAS | {
    "received_submissions": schema_for(_KEY + ["raw_inbound_submission"]),
    "qa_tbl": schema_for(_KEY + STANDARD_COLUMNS + _QA_FLAGS),
    "no_match_tbl": schema_for(NO_MATCH_COLUMNS),
    "fuzzy_matched_none_tbl": schema_for(_LINKED),
    "fuzzy_matched_review_tbl": schema_for(_LINKED),
    "fuzzy_without_demo_tbl": schema_for(_LINKED),
    "fuzzy_matched_roster_tbl": schema_for(_LINKED),
    "id_matched": schema_for(_KEY + ["CASE_ID"] + STANDARD_COLUMNS),
    "rostered_tbl": schema_for(_LINKED),
    "manual_review_resp": schema_for(REVIEW_COLUMNS + ["good_match", "resolved", "notes"]),
}

#: The same with receipts of changing columns.
VARIANT_SCHEMAS = LEDGER_SCHEMAS | {
    "received_submissions": schema_for(_KEY) + ", raw_inbound_submission variant"}

# bucket of a finished run -> ledger table it is appended to
PACKAGE_ROUTES = [
    ("qa_issues", "qa_tbl"),
    ("received", "received_submissions"),
    ("unmatched", "no_match_tbl"),
    ("unmatched", "fuzzy_matched_none_tbl"),
    ("fuzzy", "fuzzy_matched_review_tbl"),
    ("id_matched", "id_matched"),
    ("combined_roster", "rostered_tbl"),
    ("reviewed", "rostered_tbl"),
    ("no_demo", "fuzzy_without_demo_tbl"),
]
# the catalog deployment keeps fewer tables, under other names
CATALOG_ROUTES = [
    ("qa_issues", "qa_tbl_resp"),
    ("received", "received_submissions_resp"),
    ("unmatched", "unmatched_resp"),
    ("fuzzy", "fuzzy_matched_resp"),
    ("no_demo", "no_demo_resp"),
    ("exact", "exact_matched_resp"),
]
CATALOG_SCHEMAS = KEPT_SCHEMAS | {
    "qa_tbl_resp": LEDGER_SCHEMAS["qa_tbl"],
    "received_submissions_resp": LEDGER_SCHEMAS["received_submissions"],
    "unmatched_resp": LEDGER_SCHEMAS["no_match_tbl"],
    "fuzzy_matched_resp": LEDGER_SCHEMAS["fuzzy_matched_review_tbl"],
    "no_demo_resp": LEDGER_SCHEMAS["fuzzy_without_demo_tbl"],
    "exact_matched_resp": LEDGER_SCHEMAS["rostered_tbl"],
    "fuzzy_review_resp": LEDGER_SCHEMAS["manual_review_resp"],
    "roster_resp": schema_for(ROSTER_COLUMNS),
}


@dataclass(frozen=True)
class Deployment:
    """The ledger tables of a deployment: where buckets go, and which ones later runs read."""

    routes: tuple[tuple[str, str], ...]
    rostered: str
    no_match: str
    reviews: str
    rematched: str
    sheets: str
    roster: str | None = None  # keyed on ROSTER_KEY


PACKAGE = Deployment(
    tuple(PACKAGE_ROUTES), rostered="rostered_tbl", no_match="no_match_tbl",
    reviews="fuzzy_matched_review_tbl", rematched="fuzzy_matched_roster_tbl",
    sheets="manual_review_resp")
# record-number and reviewed matches have no table of their own there and join the exact ones
CATALOG = Deployment(
    (*CATALOG_ROUTES, ("id_matched", "exact_matched_resp"), ("reviewed", "exact_matched_resp")),
    rostered="exact_matched_resp", no_match="unmatched_resp", reviews="fuzzy_matched_resp",
    rematched="exact_matched_resp", sheets="fuzzy_review_resp", roster="roster_resp")


@dataclass(frozen=True)
class LinkConfig:
    """Demographic linkage: 100 is an exact name, days count both ways.

    ``birth_date_slips`` sends persons that nothing else links through a second pass, which
    proposes cases with a mistyped birth date for review.
    """

    threshold: int = 80
    day_window: int = 5
    birth_date_slips: bool = False


@dataclass(frozen=True)
class EngineConfig:
    run_date: dt.date
    link: LinkConfig = field(default_factory=LinkConfig)
    primary_key: str = "PHLAccessionNumber"
    strict_dob_rule: bool = False
    deployment: Deployment = PACKAGE
    history_by_date: bool = False  # a rostered submission counts for its collection date only
    cutoff: str | None = None  # submissions collected after this day
    case_code: str | None = None
    variant_receipts: bool = False  # for a ledger with VARIANT_SCHEMAS
