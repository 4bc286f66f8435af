"""One registered query per operator, over whole tables."""

from __future__ import annotations

import dataclasses

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions import codes, flags
from casebind.functions.dates import business_days, parse_date
from casebind.functions.text import has_value, name_clean, split_field_slot
from casebind.operators import delta, forms, frames, history, linkage, mrn, quality, roster
from casebind.operators import history as history_ops
from casebind.plans import run, stages
from casebind.sinks import ledgers, outputs
from casebind.sources import staging, tables
from casebind.sources.ledger import Ledger
from checks.inputs import CONFIG, Inputs

KEY = "submission_number"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a function of the test inputs under a name."""
    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build
    return add


# ---- sources -------------------------------------------------------------------------------

@query("src_query")
def _(i):
    i.submissions.createOrReplaceTempView("submissions")
    return tables.src_query(i.spark, """
        SELECT SubmitterName, TestResult, count(*) AS analytes FROM submissions
        GROUP BY SubmitterName, TestResult""")


@query("src_submissions_since")
def _(i):
    return tables.submissions_since(i.submissions, "1998-01-01").select(
        "PHLAccessionNumber", "SpecimenDateCollected", "ResultTextConclusion")


@query("src_cases_by_code")
def _(i):
    return tables.cases_by_code(i.fixture("registry_events"))


@query("ref_assemble")
def _(i):
    return i.registry


@query("src_review_csv")
def _(i):
    path = staging.staging_path(i.spark, "review_csv")
    sheet = frames.keep_one(i.review_ledger.select(KEY, *S.CUMULATIVE_COLUMNS[1:]), [KEY])
    frames.align_schema(sheet, tables.REVIEW_CSV_SCHEMA).write.option("header", True).csv(path)
    return tables.review_csv(i.spark, f"{path}/*.csv").select(*S.CUMULATIVE_COLUMNS)


@query("src_ledger")
def _(i):
    return tables.open_non_matches(i.no_match)


@query("raw_receipt")
def _(i):
    return tables.receipt_as_json(
        tables.raw_receipt(i.submissions, CONFIG.primary_key, CONFIG.run_date))


@query("receipt_unnest")
def _(i):
    receipt = tables.raw_receipt(i.submissions, CONFIG.primary_key, CONFIG.run_date)
    return tables.receipt_unnest(tables.receipt_as_json(receipt), i.submissions.schema)


@query("receipt_variant")
def _(i):
    """Two runs whose sources have different columns, stored as variants and read without a schema."""
    path, even = staging.staging_path(i.spark, "receipts"), F.col("PHLAccessionNumber").rlike("[02468]$")
    for rows in (i.submissions.filter(even).drop("SubmitterName"), i.submissions.filter(~even).drop("SpecimenSource")):
        tables.receipt_as_variant(tables.raw_receipt(rows, CONFIG.primary_key, CONFIG.run_date)).write.mode(
            "append").parquet(path)
    return tables.variant_unnest(i.spark.read.parquet(path))


@query("src_form_records")
def _(i):
    path = staging.staging_path(i.spark, "form_records")
    i.forms.write.json(path)
    return tables.form_records(i.spark, path, i.forms.schema)


# ---- sinks ---------------------------------------------------------------------------------

@query("align_schema")
def _(i):
    return frames.align_schema(i.standardized, S.LEDGER_SCHEMAS["rostered_tbl"])


@query("insert_if_absent")
def _(i):
    batch = frames.align_schema(i.standardized, S.LEDGER_SCHEMAS["rostered_tbl"])
    target = frames.align_schema(i.rostered, S.LEDGER_SCHEMAS["rostered_tbl"])
    return frames.union_all(target, history.absent_rows(batch, target))


def _routed(i: Inputs, routes) -> DataFrame:
    """Rows each ledger gains; where no earlier ledger is at hand, the rostered one stands in."""
    known = i.ledgers | {"unmatched_resp": i.ledgers["no_match_tbl"]}
    targets = {table: known.get(table, i.ledgers["rostered_tbl"]) for _, table in routes}
    out = ledgers.routed_rows(targets, i.whole_run.buckets(), routes, i.whole_run.wrangled.hot)
    return frames.union_all(*[
        rows.groupBy(KEY).agg(F.count("*").alias("new_rows"))
        .select(F.lit(table).alias("ledger"), KEY, "new_rows")
        for table, rows in out.items()])


@query("route_outputs")
def _(i):
    return _routed(i, S.PACKAGE_ROUTES)


@query("route_outputs_catalog")
def _(i):
    return _routed(i, S.CATALOG_ROUTES)


@query("flag_resolved")
def _(i):
    return history.flag_resolved(i.ledgers["no_match_tbl"], i.whole_run.resolved_keys()).select(
        KEY, "WDRS_RESULT", "SPECIMEN_TYPE", "match_found")


@query("review_sheet")
def _(i):
    return i.whole_run.review_sheet()


@query("roster_csv")
def _(i):
    return outputs.roster_text(roster.create_roster(i.review_ledger, i.registry, CONFIG.run_date))


@query("rematch_out")
def _(i):
    new = {
        "fuzzy_matched_review_tbl": history.absent_rows(
            i.rematched.bucket("fuzzy"), i.ledgers["fuzzy_matched_review_tbl"]),
        "fuzzy_matched_roster_tbl": history.absent_rows(
            i.rematched.bucket("exact"), i.ledgers["rostered_tbl"]),
    }
    return frames.union_all(*[
        rows.select(F.lit(table).alias("ledger"), KEY, "CASE_ID", *S.STANDARD_COLUMNS)
        for table, rows in new.items()])


@query("cumulative_roster")
def _(i):
    return outputs.cumulative_roster(i.rostered)


@query("review_archive")
def _(i):
    to = outputs.OutputFolder(staging.staging_path(i.spark, "archive"), CONFIG.run_date, "1")
    to.review_archive(i.sheets)
    return i.spark.read.csv(to.path("qa/completed_review_archive"), header=True,
                            schema="submission_number string, CASE_ID bigint")


@query("form_updates_json")
def _(i):
    rows = forms.form_updates_text(_form_updates(i))
    return rows.select("wdrs_case_id", F.to_json(
        F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("record"))


# ---- scalar functions ----------------------------------------------------------------------

def _project(name: str, **columns: str | Callable):
    """Register a projection of the submissions: the source columns and the derived ones."""
    def build(i: Inputs) -> DataFrame:
        kept = [v for v in columns.values() if isinstance(v, str)]
        return i.submissions.select("PHLAccessionNumber", *kept, *[
            make().alias(alias) for alias, make in columns.items() if callable(make)])
    query(name)(build)


_project("performing_lab", PERFORMING_LAB_ENTIRE_REPORT=codes.performing_lab)
_project("submitting_lab", lab="SubmitterName",
         SUBMITTER=lambda: codes.submitter_code(F.col("SubmitterName")))
_project("submitter_other", lab="SubmitterName", SUBMITTER_OTHER=lambda: codes.submitter_other(
    codes.submitter_code(F.col("SubmitterName")), F.col("SubmitterName")))
_project("specimen_type", source="SpecimenSource",
         SPECIMEN_TYPE=lambda: codes.specimen_type_label(F.col("SpecimenSource")))
_project("wdrs_specimen_type", source="SpecimenSource",
         WDRS_SPECIMEN_TYPE=lambda: codes.specimen_type_code(F.col("SpecimenSource")))
_project("specimen_source_site", source="SpecimenSource",
         SPECIMEN_SOURCE_SITE=lambda: codes.specimen_site_label(F.col("SpecimenSource")))
_project("wdrs_specimen_source", source="SpecimenSource",
         WDRS_SPECIMEN_SOURCE=lambda: codes.specimen_site_code(F.col("SpecimenSource")))
_project("wdrs_test_performed", text="ResultTextConclusion",
         WDRS_TEST_PERFORMED=lambda: codes.test_performed(F.col("ResultTextConclusion")))
_project("test_performed_desc", text="ResultTextConclusion",
         TEST_PERFORMED_DESC=lambda: codes.test_performed_label(F.col("ResultTextConclusion")))
_project("wdrs_result", text="ResultTextConclusion",
         WDRS_RESULT=lambda: codes.result_code(F.col("ResultTextConclusion")))
_project("test_result", text="ResultTextConclusion",
         TEST_RESULT=lambda: codes.result_label(F.col("ResultTextConclusion")))
_project("result_summary", text="TestResult",
         WDRS_RESULT_SUMMARY=lambda: codes.result_summary(F.col("TestResult")))
_project("name_clean",
         first_name_clean=lambda: name_clean(F.col("PatientFirstName")),
         last_name_clean=lambda: name_clean(F.col("PatientLastName")))
_project("id_routing_flag", first="PatientFirstName", last="PatientLastName",
         send_to_id_matching=lambda: flags.wants_id_match(
             F.col("PatientFirstName"), F.col("PatientLastName")))
_project("date_cast", received="SpecimenDateReceived",
         received_day=lambda: F.col("SpecimenDateReceived").cast("timestamp").cast("date"))
_project("roster_note", note=lambda: codes.roster_note(CONFIG.run_date))


@query("parse_date")
def _(i):
    return i.fixture("messy_dates").select("o_orderkey", parse_date(F.col("text")).alias("parsed"))


@query("alt_source_result")
def _(i):
    return i.fixture("alt_results").select(
        "l_orderkey", "l_linenumber", codes.alt_result_code(F.col("text")).alias("WDRS_RESULT"))


@query("alt_source_test_result")
def _(i):
    return i.fixture("alt_results").select(
        "l_orderkey", "l_linenumber", codes.alt_result_label(F.col("text")).alias("TEST_RESULT"))


@query("standardize")
def _(i):
    return i.standardized.select(KEY, "PatientBirthDate", *S.STANDARD_COLUMNS)


@query("form_test_code")
def _(i):
    return i.standardized.select(
        KEY, codes.form_test_code(F.col("WDRS_TEST_PERFORMED")).alias("form_test"))


@query("form_result_code")
def _(i):
    return i.standardized.select(
        KEY, "WDRS_RESULT", codes.form_result_code(F.col("WDRS_RESULT")).alias("form_result"))


@query("split_field_slot")
def _(i):
    field, slot = split_field_slot(F.col("variable"))
    return forms.form_unpivot(i.forms).select(
        "CaseID", "variable", field.alias("field"), slot.alias("lab_number"))


@query("key_as_string")
def _(i):
    return i.registry.select(F.col("CASE_ID").cast("string").alias("CASE_ID"), "RESPNET_CASE_ID")


@query("column_selectors")
def _(i):
    checked = i.wrangled.checked
    return checked.select(
        KEY, *frames.columns_matching(checked, "qa_"), *frames.columns_matching(checked, "_DTTM$"))


# ---- QA and splits -------------------------------------------------------------------------

def _flag(name: str, alias: str, make: Callable):
    query(name)(lambda i: i.standardized.select(KEY, make().alias(alias)))


_flag("qa_test_performed", "qa_wdrs_test_performed", lambda: flags.missing(F.col("WDRS_TEST_PERFORMED")))
_flag("qa_test_desc", "qa_test_performed_desc", lambda: flags.missing(F.col("TEST_PERFORMED_DESC")))
_flag("qa_result", "qa_wdrs_result", lambda: flags.unknown_result(F.col("WDRS_RESULT")))
_flag("qa_result_summary", "qa_wdrs_result_summary",
      lambda: flags.unknown_summary(F.col("WDRS_RESULT_SUMMARY")))
_DOB_INPUT = ("PatientFirstName", "PatientLastName", "PatientBirthDate")
_flag("qa_missing_dob", "qa_missing_dob", lambda: flags.missing_dob(*map(F.col, _DOB_INPUT)))
_flag("qa_missing_dob_strict", "qa_missing_dob",
      lambda: flags.missing_dob(*map(F.col, _DOB_INPUT), strict=True))


@query("qa_flag")
def _(i):
    checked = quality.add_flags(i.standardized)
    return checked.select(KEY, *frames.columns_matching(checked, "qa_"))


@query("clean_split")
def _(i):
    return i.wrangled.clean.select(KEY, *S.STANDARD_COLUMNS)


@query("issue_split")
def _(i):
    return i.wrangled.issues


@query("positive_only")
def _(i):
    return roster.positive_only(i.standardized).select(KEY, "WDRS_RESULT", "WDRS_RESULT_SUMMARY")


@query("has_mrn")
def _(i):
    return i.submissions.filter(has_value(F.col("SubmitterPatientNumber"))).select(
        "PHLAccessionNumber", "SubmitterPatientNumber")


@query("looks_like_id")
def _(i):
    return mrn.id_unpivot(i.pulled.submissions).select(KEY, "variable", "MRN")


@query("key_present")
def _(i):
    return i.registry.filter(F.col("CASE_ID").isNotNull() & F.col("SPECIMEN_COLLECTION_DTTM").isNotNull()
                             ).select("CASE_ID", "SPECIMEN_COLLECTION_DTTM")


@query("non_empty_input")
def _(i):
    """Whether the guard of the match stage lets the submissions through."""
    empty = dataclasses.replace(i.pulled, submissions=i.pulled.submissions.filter("false"))
    decided = []
    for pulled in (i.pulled, empty):
        try:
            stages.require_submissions(pulled)
            decided.append(True)
        except ValueError:
            decided.append(False)
    return i.submissions.limit(1).select(F.lit(decided[0]).alias("has_rows"),
                                         F.lit(decided[1]).alias("empty_has_rows"))


@query("fuzzy_projection")
def _(i):
    return i.wrangled.to_link


@query("qa_multiple_subtypes")
def _(i):
    return quality.multiple_subtypes(i.standardized).select(
        KEY, "qa_multiple_subtypes", *S.STANDARD_COLUMNS)


@query("qa_multiple_subtypes_v1")
def _(i):
    return quality.multiple_subtypes_v1(i.standardized).select(
        KEY, "qa_multiple_subtypes", *S.STANDARD_COLUMNS)


@query("sort_by_count")
def _(i):
    return quality.subtype_counts(i.standardized)


# ---- joins ---------------------------------------------------------------------------------

@query("ref_join")
def _(i):
    return i.registry.groupBy("CASE_ID").agg(
        F.count("SPECIMEN_COLLECTION_DTTM").alias("labs"),
        F.max("SPECIMEN_COLLECTION_DTTM").alias("last_lab"))


@query("not_yet_rostered")
def _(i):
    return history.not_yet_rostered(i.standardized, i.rostered).select(KEY, *S.STANDARD_COLUMNS)


@query("not_yet_rostered_by_date")
def _(i):
    return history.not_yet_rostered(i.standardized, i.rostered, with_date=True).select(
        KEY, *S.STANDARD_COLUMNS)


@query("semi_flag")
def _(i):
    several = quality.multiple_subtypes(i.standardized)
    return history.semi_flag(i.standardized, several, [KEY], "qa_multiple_subtypes").select(
        KEY, "WDRS_RESULT", "qa_multiple_subtypes")


@query("attach_original")
def _(i):
    return i.matched.linked.select(
        "bucket", *S.REVIEW_COLUMNS, *S.STANDARD_COLUMNS)


@query("mrn_join")
def _(i):
    ids = mrn.id_unpivot(i.pulled.submissions).select(KEY, "MRN").distinct()
    return ids.join(mrn.case_mrns(i.registry), "MRN")


@query("mrn_recover")
def _(i):
    return mrn.mrn_recover(
        i.no_match.select(KEY).distinct(), i.pulled.submissions, CONFIG.primary_key)


@query("review_merge")
def _(i):
    # a submission may come back on several sheets
    return stages.review_merge(i.review_ledger, i.sheets.union(i.sheets))


@query("roster_enrich")
def _(i):
    return roster.roster_enrich(i.review_ledger, i.registry)


@query("roster_vs_registry")
def _(i):
    rows = roster.create_roster(i.rostered, i.registry, CONFIG.run_date)
    return roster.not_in_registry(rows, i.registry).select(*S.ROSTER_KEY)


def _reviewed_roster(i: Inputs) -> DataFrame:
    return roster.create_roster(i.review_ledger, i.registry, CONFIG.run_date)


@query("form_join")
def _(i):
    return forms.form_join(_reviewed_roster(i), i.forms)


@query("anti_insert")
def _(i):
    return history.absent_rows(i.no_match, i.rostered).select(KEY, "WDRS_RESULT", "TEST_RESULT")


@query("demographic_link")
def _(i):
    return i.all_link.rows.select(KEY, *linkage.PERSON, *linkage.MATCH, "bucket")


# ---- linkage -------------------------------------------------------------------------------

def _all_people(i: Inputs) -> DataFrame:
    return linkage.people(i.standardized)


@query("no_demo_split")
def _(i):
    return linkage.no_demo_split(_all_people(i).distinct())[1]


@query("candidate_block")
def _(i):
    persons, _ = linkage.no_demo_split(_all_people(i))
    return linkage.candidates(persons, linkage.reference_people(i.registry), CONFIG.link)


@query("business_day_count")
def _(i):
    return i.spark.table("lineitem").join(
        i.spark.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate",
        business_days(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date"))
        .alias("business_day_count"))


def _true_pairs(i: Inputs) -> DataFrame:
    """Each submission with the registry person it was made from."""
    cases = i.fixture("wizard").select(
        "CASE_ID", name_clean(F.col("FIRST_NAME")).alias("ref_first"),
        name_clean(F.col("LAST_NAME")).alias("ref_last"))
    labelled = i.fixture("history").select(KEY, "CASE_ID")
    persons = _all_people(i).filter(linkage.complete()).distinct()
    return persons.join(labelled, KEY).join(cases, "CASE_ID")


def _ratio(name: str, make: Callable):
    query(name)(lambda i: _true_pairs(i).select(KEY, "CASE_ID", make(
        *map(F.col, ("first_name_clean", "last_name_clean", "ref_first", "ref_last"))).alias(name)))


_ratio("match_ratio", linkage.match_ratio)
_ratio("reverse_match_ratio", linkage.reverse_match_ratio)


def _bucket(name: str, bucket: str):
    query(name)(lambda i: i.all_link.bucket(bucket).select(KEY, *linkage.PERSON, *linkage.MATCH))


_bucket("exact_link", "exact")
_bucket("fuzzy_link", "fuzzy")
_bucket("unmatched", "unmatched")


@query("best_match")
def _(i):
    # both sides are read several times
    persons = staging.staged(_all_people(i).filter(linkage.complete()).select(*linkage.PERSON).distinct(), "persons")
    people = staging.staged(linkage.reference_people(i.registry), "people")
    return linkage.link_persons(persons, people, CONFIG.link, staging.staged).drop("bucket")


@query("triage_counts")
def _(i):
    return i.all_link.counts()


@query("triage_by_result")
def _(i):
    """The flagship: how many submissions link, by result code."""
    linked = linkage.attach_original(i.all_link, i.standardized, columns=["WDRS_RESULT"])
    return linked.groupBy("WDRS_RESULT", "bucket").agg(
        F.count("*").alias("analytes"), F.countDistinct(KEY).alias("submissions"))


# ---- record numbers ------------------------------------------------------------------------

@query("mrn_explode")
def _(i):
    return mrn.mrn_explode(i.registry).select("CASE_ID", *mrn.MRN_LISTS)


@query("mrn_pick")
def _(i):
    first, second = map(F.col, mrn.MRN_LISTS)
    return mrn.mrn_explode(i.fixture("wizard")).select(
        "CASE_ID", mrn.mrn_pick(first, second).alias("MRN")).filter(F.col("MRN").isNotNull())


@query("mrn_candidates")
def _(i):
    return mrn.mrn_candidates(i.all_link).select(KEY, *mrn.ID_FIELDS)


@query("id_unpivot")
def _(i):
    return mrn.id_unpivot(mrn.mrn_candidates(i.all_link)).select(KEY, "variable", "MRN")


@query("mrn_link")
def _(i):
    return mrn.mrn_link(mrn.mrn_candidates(i.all_link), i.registry)


@query("id_matched_full")
def _(i):
    return i.matched.id_matched


# ---- aggregation, one row per key, unions --------------------------------------------------

@query("first_empty_slot")
def _(i):
    return forms.first_empty_slot(forms.slot_pivot(forms.form_unpivot(i.forms)))


@query("slot_pivot")
def _(i):
    return forms.slot_pivot(forms.form_unpivot(i.forms))


@query("bucket_counts")
def _(i):
    return i.matched.linked.groupBy("bucket").agg(
        F.count("*").alias("analytes"), F.countDistinct(KEY).alias("submissions"))


@query("keep_one_per_key")
def _(i):
    return frames.keep_one(i.standardized.select(KEY, *S.STANDARD_COLUMNS), [KEY])


@query("distinct_rows")
def _(i):
    return frames.distinct_rows(i.standardized.select(
        "SUBMITTER", "WDRS_RESULT", "WDRS_RESULT_SUMMARY", "SPECIMEN_TYPE", "TEST_PERFORMED_DESC"))


@query("roster_unique")
def _(i):
    rows = roster.positive_only(i.review_ledger).withColumnRenamed("CASE_ID", "CaseID")
    return frames.keep_one(rows.select(*S.ROSTER_KEY, "SUBMITTER", "WDRS_SPECIMEN_TYPE"), S.ROSTER_KEY)


@query("union_all")
def _(i):
    return frames.union_all(i.all_link.unmatched, i.all_link.no_demo).select(KEY, *linkage.PERSON)


@query("union_diagonal")
def _(i):
    return frames.union_diagonal(
        i.rostered.select(KEY, "CASE_ID", "WDRS_RESULT", "first_name_clean"),
        i.no_match.select(KEY, "WDRS_RESULT", "match_found"))


@query("union_rosters")
def _(i):
    return i.whole_run.roster


@query("form_unpivot")
def _(i):
    return forms.form_unpivot(i.forms)


@query("slot_fill")
def _(i):
    return forms.slot_fill(forms.form_join(_reviewed_roster(i), i.forms)).select(
        "CaseID", *forms.SLOT_COLUMNS)


def _form_updates(i: Inputs) -> DataFrame:
    return forms.form_updates(_reviewed_roster(i), i.forms, i.registry)


@query("form_updates")
def _(i):
    return _form_updates(i)


# ---- stages --------------------------------------------------------------------------------

@query("pull")
def _(i):
    return i.pulled.submissions


@query("wrangle")
def _(i):
    parts = [("clean", i.wrangled.clean), ("issues", i.wrangled.issues)]
    return frames.union_all(*[
        rows.select(KEY, *S.STANDARD_COLUMNS, F.lit(part).alias("part")) for part, rows in parts])


@query("match")
def _(i):
    return i.matched.combined_roster


@query("rematch")
def _(i):
    return i.rematched.combined_roster


@query("create_roster")
def _(i):
    return _reviewed_roster(i)


@query("dedup_roster")
def _(i):
    return roster.dedup_roster(_reviewed_roster(i), i.registry)


@query("dedup_roster_row_wise")
def _(i):
    return roster.dedup_roster_row_wise(_reviewed_roster(i), i.registry)


@query("reviewed_roster")
def _(i):
    return i.reviews.roster


def _by_key(name: str, rows: DataFrame, key: str = KEY) -> DataFrame:
    closed = F.count_if(F.col("match_found")) if "match_found" in rows.columns else F.lit(0)
    return rows.groupBy(F.col(key).cast("string").alias("key")).agg(
        F.count("*").alias("n"), closed.cast("bigint").alias("closed")).withColumn("name", F.lit(name))


@query("combine_and_write")
def _(i):
    """All ledgers, as earlier runs left them and after the run has been written."""
    ledger = Ledger(i.spark, staging.staging_path(i.spark, "ledgers"))
    for table, rows in i.ledgers.items():
        ledger.append(table, rows)
    run.combine_and_write(i.whole_run, ledger, staging.staging_path(i.spark, "files"), i.forms, CONFIG)
    return frames.union_all(*[_by_key(name, ledger.read(name)) for name in S.LEDGER_SCHEMAS
                              if name not in S.KEPT_SCHEMAS])


@query("run")
def _(i):
    """Everything a run yields, row by row as far as its key tells."""
    result = i.whole_run
    kinds = result.buckets() | {
        "review_sheet": result.review_sheet(), "resolved": result.resolved_keys().distinct()}
    others = {"roster": (result.roster, "CaseID"), "form_updates": (
        forms.form_updates(result.roster, i.forms, i.registry), "wdrs_case_id")}
    kinds.pop("roster")
    return frames.union_all(
        *[_by_key(kind, rows.drop("match_found")) for kind, rows in kinds.items()],
        *[_by_key(kind, rows, key) for kind, (rows, key) in others.items()])


# ---- incremental work ----------------------------------------------------------------------

@query("rematch_delta")
def _(i):
    """Open non-matches that cases of even number did not link, retried when the others come."""
    ledger = i.ledgers["no_match_tbl"]
    history = history_ops.not_yet_rostered(tables.open_non_matches(ledger), i.ledgers["rostered_tbl"])
    persons = linkage.people(history, linkage.LEDGER).filter(linkage.complete()).select(*linkage.PERSON).distinct()
    early = staging.staged(linkage.reference_people(i.registry.filter("CASE_ID % 2 = 0")), "early")
    people = staging.staged(linkage.reference_people(i.registry), "people")
    still = staging.staged(persons.join(
        linkage.link_persons(persons, early, CONFIG.link, staging.staged), linkage.PERSON, "left_anti"), "still")
    seen = delta.Compared(still, early, None, None)
    return delta.delta_links(still, people, seen, CONFIG.link, staging.staged)[0]


@query("ledger_resolve")
def _(i):
    """A flagged ledger after two runs have resolved some of its open rows."""
    ledger = Ledger(i.spark, staging.staging_path(i.spark, "flagged"))
    ledger.append("no_match_tbl", i.no_match)
    for digit in ("3", "8"):
        keys = i.submissions.select(F.col("PHLAccessionNumber").alias(KEY)).filter(F.col(KEY).endswith(digit))
        ledger.resolve("no_match_tbl", keys)
    return ledger.read("no_match_tbl").select(*S.NO_MATCH_COLUMNS)


@query("cumulative_snapshot")
def _(i):
    """The cumulative roster after two runs, each merged into the snapshot of the one before."""
    ledger = Ledger(i.spark, staging.staging_path(i.spark, "rostered"))
    first = F.crc32(F.col(KEY).cast("binary")) % 2 == 0
    for part in (first, ~first | F.col(KEY).endswith("1")):
        ledger.append("rostered_tbl", i.rostered.filter(part))
        rows = ledgers.cumulative(ledger, "rostered_tbl")
    return rows


@query("src_review_rejects")
def _(i):
    """Review sheets of which a spreadsheet has rewritten some birth dates."""
    path = staging.staging_path(i.spark, "review_rejects")
    sheet = frames.keep_one(i.review_ledger.select(KEY, *S.CUMULATIVE_COLUMNS[1:]), [KEY])
    sheet = frames.align_schema(sheet, tables.REVIEW_CSV_SCHEMA).withColumn("submitted_dob", F.when(
        F.col(KEY).endswith("7"), F.date_format("submitted_dob", "M/d/yyyy")).otherwise(
        F.col("submitted_dob").cast("string")))
    sheet.write.option("header", True).csv(path)
    rows, rejects = tables.review_sheets(i.spark, f"{path}/*.csv")
    first_cell = F.split_part(tables.REJECT, F.lit(","), F.lit(1))
    return rows.select(KEY, "submitted_dob", F.lit(False).alias("rejected")).unionByName(rejects.select(
        first_cell.alias(KEY), F.lit(None).cast("date").alias("submitted_dob"), F.lit(True).alias("rejected")))


@query("birth_date_slips")
def _(i):
    """Every submission's person with a slip in the birth date, against the registry."""
    dob = F.col("submitted_dob")
    slipped = F.when(F.day(dob) <= 12, F.make_date(F.year(dob), F.day(dob), F.month(dob))).otherwise(
        F.date_add(dob, 1))
    persons = _all_people(i).withColumn("submitted_dob", slipped).filter(linkage.complete())
    pairs = linkage.birth_date_slips(
        persons.select(*linkage.PERSON).distinct(), linkage.reference_people(i.registry), CONFIG.link)
    return pairs.select(*linkage.PERSON, "first_name_clean_right", "last_name_clean_right",
                        "reference_collection_date", "CASE_ID").distinct()
