"""Known inputs and outputs of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions import codes, flags
from casebind.functions.dates import business_days, parse_date
from casebind.functions.text import literal_alternatives, name_clean, split_field_slot, strip

RESULTS = [
    "Influenza A virus detected by RT-PCR {58}",
    "Influenza A(2009 H1N1) virus detected by RT-PCR {65}",
    "Influenza A(H3) virus detected by RT-PCR {64}",
    "Influenza A(H5) virus detected by RT-PCR {70}",
    "Influenza A(H7) virus detected by RT-PCR",
    "Influenza B virus detected by RT-PCR {59}",
    "Influenza B/Victoria lineage detected by RT-PCR {91}",
    "Influenza B/Yamagata lineage detected by RT-PCR {91}",
    "Inconclusive - Invalid Result {68}",
    "Random",
    None,
]


def run(spark, values, make, *more):
    rows = [(i, v) if not isinstance(v, tuple) else (i, *v) for i, v in enumerate(values)]
    names = ["i", "x", "y"][: len(rows[0])]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, ["int", "string", "string"])))
    return [r[0] for r in df.orderBy("i").select(make(*[F.col(n) for n in names[1:]])).collect()]


def test_result_codes(spark):
    assert run(spark, RESULTS, codes.result_code) == [
        "G_FLU_A_D", "G_FLU_A_(09_PDM_H1N1)_D", "G_FLU_A_(H3)_D", "G_FLU_A_(H5)_D", "G_FLU_A_(H7)_D",
        "G_FLU_B", "G_FLU_B_(VICTORIA)_D", "G_FLU_B_(YAMAGATA)_D", "G_FLU_ND", "Random", None]


def test_result_labels(spark):
    assert run(spark, RESULTS, codes.result_label) == [
        "Influenza A detected", "Influenza A (09 Pdm H1N1) detected", "Influenza A (H3) detected",
        "Influenza A (H5) detected", "Influenza A (H7) detected", "Influenza B detected",
        "Influenza B (Victoria) detected", "Influenza B (Yamagata) detected",
        "Influenza not detected", "Random", None]


def test_alternate_laboratory(spark):
    texts = ["Influenza A H1N1 detected", "Influenza A H3N2 detected", "Influenza B detected",
             "Influenza B virus detected by RT-PCR", " x "]
    assert run(spark, texts, codes.alt_result_code) == [
        "G_FLU_A_(09_PDM_H1N1)_D", "G_FLU_A_(H3)_D", "G_FLU_B",
        "Influenza B virus detected by RT-PCR", "x"]


def test_rules_also_take_real_patterns(spark):
    rules = [(r"^Flu [AB]\d", "typed", "Typed"), ("Flu", "any", "Any")]
    position = lambda x: codes.rule_value(codes.first_rule(x, rules), x, rules)
    assert run(spark, ["Flu A1", "a Flu A1", "none "], position) == ["typed", "any", "none"]
    assert literal_alternatives(r"A\(H3\)|B") == ["A(H3)", "B"]
    assert literal_alternatives(r"\d+") is None


def test_first_matching_rule_wins_inside_numbers(spark):
    assert run(spark, ["Influenza A virus detected by RT-PCR {160}"], codes.result_code) == ["G_FLU_ND"]


@pytest.mark.parametrize("make,value", [
    (codes.test_performed, "G_PCR"),
    (codes.test_performed_label, "PCR/Nucleic Acid Test (NAT, NAAT, DNA)")])
def test_test_performed(spark, make, value):
    texts = [RESULTS[1], RESULTS[6], "Inconclusive - sample below limit of detection of test {61}",
             RESULTS[5], None]
    assert run(spark, texts, make) == [value, value, None, value, None]


def test_result_summary(spark):
    assert run(spark, ["Not Detected {52}", "Detected {51}", "Test {53}", None], codes.result_summary) == [
        "G_NEGATIVE", "G_POSITIVE", None, None]


@pytest.mark.parametrize("make,value", [
    (codes.specimen_type_label, "Swab-nasopharyngeal (NP)"), (codes.specimen_type_code, "G_SWAB-NP"),
    (codes.specimen_site_label, "Nasopharyngeal (NP) swab"), (codes.specimen_site_code, "G_NP_SWAB")])
def test_specimens(spark, make, value):
    assert run(spark, ["Respiratory: NP swab", "random", None], make) == [value, None, None]


def test_specimens_without_a_type(spark):
    texts = ["Resipiratory: nasal swab", "Nasopharyngeal Swab (NP)", "Conjunctival Swab"]
    assert run(spark, texts, codes.specimen_site_code) == [None, "G_NP_SWAB", "G_EYE"]
    assert run(spark, texts, codes.specimen_type_label) == [None, "Swab-nasopharyngeal (NP)", None]


def test_submitters(spark):
    labs = ["Labcorp - Seattle Cherry Hill", "Providence Reg Med Ctr - Everett",
            "University of Washington Medical Center", "Some Random Lab", None, "Everett Clinic Laboratory"]
    assert run(spark, labs, codes.submitter_code) == [
        "6130705570", "85742", "88215", "27782022", "27782022", "85742"]
    pairs = [("85740", "Everett Clinic Laboratory"), ("27782022", "some random lab"), ("27782022", None)]
    assert run(spark, pairs, codes.submitter_other) == [None, "some random lab", None]
    assert run(spark, ["a"], lambda x: codes.performing_lab()) == ["81596"]


def test_dates_in_every_spelling(spark):
    texts = ["2024-10-30", "10-30-2024", "October 30, 2024", "45496", "11/7/2021", "12/10/2023",
             "2/30/2024", "not a date", "", None]
    day = dt.date(2024, 10, 30)
    assert run(spark, texts, parse_date) == [
        day, day, day, dt.date(2024, 7, 23), dt.date(2021, 11, 7), dt.date(2023, 12, 10),
        None, None, None, None]


def test_business_days_match_counting(spark):
    days = [dt.date(1969, 12, 20) + dt.timedelta(d) for d in range(40)]
    pairs = [(str(a), str(b)) for a in days for b in days]

    def count(a, b):
        low, high = sorted((dt.date.fromisoformat(a), dt.date.fromisoformat(b)))
        return sum((low + dt.timedelta(d)).weekday() < 5 for d in range(1, (high - low).days + 1))

    got = run(spark, pairs, lambda a, b: business_days(a.cast("date"), b.cast("date")))
    assert got == [count(a, b) for a, b in pairs]


def test_text_helpers(spark):
    assert run(spark, ["O'Brien-2", " Ann Marie ", "123", None], name_clean) == ["obrien", "annmarie", "", None]
    assert run(spark, ["  RP \t", None], strip) == ["RP", None]
    assert run(spark, ["tsttyp2", "hosplab", "12"], lambda x: F.struct(*split_field_slot(x))) == [
        ("tsttyp", 2), ("hosplab", None), ("", 12)]


def test_flags_are_never_null(spark):
    assert run(spark, ["G_FLU_ND", "G_FLU_A_D", "Random Value", None], flags.unknown_result) == [
        False, False, True, True]
    assert run(spark, ["G_POSITIVE", "G_NEGATIVE", None], flags.unknown_summary) == [False, False, True]
    assert run(spark, ["x", None], flags.missing) == [False, True]
    names = [("ann", "lee"), ("M12", "lee"), (None, "lee"), ("", "lee")]
    no_date = F.lit(None).cast("date")
    assert run(spark, names, lambda a, b: flags.missing_dob(a, b, no_date)) == [True, False, False, False]
    assert run(spark, names, lambda a, b: flags.missing_dob(a, b, no_date, strict=True)) == [False] * 4
    assert run(spark, names, flags.wants_id_match) == [False, True, False, False]


def test_form_codes(spark):
    values = ["G_FLU_A_(H7)_D", "G_FLU_B", "G_FLU_A/B", "nope", None]
    assert run(spark, values, codes.form_result_code) == [11, 2, 4, None, None]
    assert run(spark, ["G_FLU_B"], lambda x: codes.form_result_code(x, additions=False)) == [None]
    assert run(spark, ["G_PCR", "G_OTHER", "x"], codes.form_test_code) == [2, 6, None]


def test_roster_layout_is_fixed():
    assert len(S.ROSTER_COLUMNS) == 55 and len(set(S.ROSTER_COLUMNS)) == 55
    assert len(S.SUBMITTER_CODES) == 22 and len(S.STANDARD_COLUMNS) == 15


def test_dates_with_a_time_or_white_space(spark):
    day = dt.date(2024, 10, 30)
    values = ["2024-10-30 00:00:00", "2024-10-30T08:00:00", " 10/30/2024", "10/30/2024 8:05 AM", "45595.0",
              "45595.75", "2024-10-30T08:00:00.123Z", "2024-10-30", "nonsense 00:00:00"]
    assert run(spark, values, parse_date) == [day] * 8 + [None]


def test_names_keep_letters_of_every_script(spark):
    assert run(spark, ["José-2", "ИВАН", "李 小龙", "Ångström"], name_clean) == ["josé", "иван", "李小龙", "ångström"]
