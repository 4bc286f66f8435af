"""Whole-run invariants and the two-run scenario."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.operators import forms, quality, roster
from casebind.operators.standardize import standardize
from casebind.plans import run as runs
from casebind.plans import stages
from casebind.sources.staging import staged
from casebind.sources.ledger import CatalogLedger, Ledger
from casebind.sinks import ledgers
from checks.inputs import CONFIG

KEY = "submission_number"


def keys(df):
    return {r[KEY] for r in df.select(KEY).distinct().collect()}


def test_buckets_partition_the_input(finished):
    link = finished.main.link
    assert link.rows.count() == link.rows.select(KEY).distinct().count()
    parts = [keys(link.bucket(b)) for b in ("exact", "fuzzy", "unmatched", "no_demo")]
    assert all(parts) and sum(map(len, parts)) == len(set.union(*parts))
    assert set.union(*parts) == keys(finished.wrangled.clean)
    assert finished.main.linked.count() == finished.wrangled.clean.count()


def test_split_loses_only_negatives(finished):
    checked = finished.wrangled.checked
    dropped = checked.filter(
        F.col("WDRS_RESULT_SUMMARY").eqNullSafe("G_NEGATIVE")
        | (~F.col("qa_flag") & (F.col("WDRS_RESULT") == "G_FLU_ND"))).count()
    assert checked.count() == dropped + finished.wrangled.clean.count() + finished.wrangled.issues.count()


def test_exact_links_find_the_person_they_came_from(finished, inputs):
    made_from = inputs.spark.table("orders").select(
        F.concat(F.lit("WA"), "o_orderkey").alias(KEY), (F.col("o_custkey") + 100000).alias("truth"))
    wrong = finished.main.link.exact.join(made_from, KEY).filter("CASE_ID <> truth")
    assert wrong.count() == 0


def test_one_shuffle_history_check_equals_the_separate_ones(inputs):
    both = quality.with_history_and_subtypes(inputs.standardized, inputs.rostered)
    from casebind.operators import history
    left = history.not_yet_rostered(inputs.standardized, inputs.rostered)
    apart = history.semi_flag(left, quality.multiple_subtypes(left), [KEY], "qa_multiple_subtypes")
    assert both.exceptAll(apart.select(*both.columns)).count() == 0
    assert both.count() == apart.count()


def test_multiple_subtypes_example(spark):
    rows = spark.createDataFrame(
        [("200", "G_POSITIVE", "Influenza A (09 Pdm H1N1) detected", "G_FLU_A_(09_PDM_H1N1)_D"),
         ("200", "G_POSITIVE", "Influenza A (H3) detected", "G_FLU_A_(H3)_D"),
         ("201", "G_POSITIVE", "Influenza A (H3) detected", "G_FLU_A_(H3)_D"),
         ("202", "G_POSITIVE", "RP", "G_FLU_A_(H5)_D"), ("202", "G_POSITIVE", None, "G_FLU_A_(H7)_D")],
        "submission_number string, s string, l string, r string")
    out = quality.multiple_subtypes(rows, "s", "l", "r").collect()
    assert [(r[KEY], r["qa_multiple_subtypes"]) for r in out] == [("200", True)] * 2


def test_free_slot_without_reshaping_equals_the_long_way(inputs):
    short = forms.case_free_slot(inputs.forms)
    long = forms.first_empty_slot(forms.slot_pivot(forms.form_unpivot(inputs.forms)))
    assert short.count() > 0
    assert short.exceptAll(long).count() == long.exceptAll(short).count() == 0


def test_rostered_rows_are_unique_and_new(finished, inputs):
    rows = roster.create_roster(inputs.review_ledger, inputs.registry, CONFIG.run_date)
    assert rows.columns == S.ROSTER_COLUMNS
    assert rows.count() == rows.select(*S.ROSTER_KEY).distinct().count()
    kept = roster.not_in_registry(rows, inputs.registry)
    assert 0 < kept.count() < rows.count()
    # as first written, the blank label equals nothing in the registry
    assert roster.dedup_roster_row_wise(rows, inputs.registry).count() == rows.count()


def test_no_submissions_is_an_error(inputs):
    empty = dataclasses.replace(inputs.pulled, submissions=inputs.pulled.submissions.filter("false"))
    with pytest.raises(ValueError):
        stages.match(empty, None, CONFIG)


def counts(ledger):
    return {table: ledger.read(table).count() for table in ledger.schemas}


def test_two_runs(spark, inputs, tmp_path):
    """Run, run again, then let a case appear for an old non-match."""
    ledger, folder = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")
    submissions = inputs.submissions.filter("PHLAccessionNumber < 'WA2'")
    wizard, labs = inputs.fixture("wizard"), inputs.fixture("investigation")
    given = runs.Inputs(submissions, wizard, labs, inputs.sheets.filter("false"), inputs.forms)

    first = runs.run(given, ledger, folder, CONFIG, write_data=True)
    before = counts(ledger)
    assert before["rostered_tbl"] and before["no_match_tbl"] and before["qa_tbl"] and before["id_matched"]
    assert before["received_submissions"] == submissions.count()
    assert before["manual_review_resp"] == len(keys(first.main.bucket("fuzzy")))
    assert spark.read.json(f"{folder}/form_updates").count() > 0
    assert spark.read.csv(f"{folder}/subtype_roster", header=True).count() == first.roster.count()

    second = runs.run(given, ledger, folder, CONFIG, write_data=True)
    # rostered submissions are not looked at again; everything else is written once only
    assert counts(ledger) == before
    assert second.roster.isEmpty()
    # and the files of the first run of the day are as they were
    written = spark.read.csv(f"{folder}/subtype_roster", header=True)
    assert written.filter(F.col("run") == first.run_id).count() == written.count() == first.roster.count()

    # one non-match: give its person a registry case
    lost = ledger.read("no_match_tbl").filter(
        "NOT match_found AND first_name_clean <> '' AND last_name_clean <> '' AND length(first_name_clean) > 2").select(
        KEY, "first_name_clean", "last_name_clean", "submitted_dob", "submitted_collection_date").first()
    new_case = spark.createDataFrame(
        [(1, "RC1", "EX1", lost["first_name_clean"], None, lost["last_name_clean"], lost["submitted_dob"], None, None)],
        wizard.schema)
    new_lab = spark.createDataFrame([(1, lost["submitted_collection_date"], "Influenza A detected")], labs.schema)
    later = dataclasses.replace(CONFIG, run_date=dt.date(2024, 6, 2))
    third = runs.run(
        dataclasses.replace(given, wizard=wizard.union(new_case), investigation=labs.union(new_lab)),
        ledger, folder, later, write_data=True)
    assert third.again.bucket("exact").filter(F.col(KEY) == lost[KEY]).first()["CASE_ID"] == 1
    flags = {r["match_found"] for r in ledger.read("no_match_tbl").filter(F.col(KEY) == lost[KEY]).collect()}
    assert flags == {True}
    assert ledger.read("fuzzy_matched_roster_tbl").filter(F.col(KEY) == lost[KEY]).count() > 0

    # a reviewer returns one sheet
    one = ledger.read("manual_review_resp").orderBy(KEY).limit(1)
    reviewed = runs.run(dataclasses.replace(given, review_sheets=one), ledger, folder, later, write_data=True)
    assert keys(reviewed.reviews.reviewed) == keys(one)
    assert keys(one) <= keys(ledger.read("rostered_tbl"))
    # the sheet stays where it is, and is rostered once
    again = runs.run(dataclasses.replace(given, review_sheets=one.union(one)), ledger, folder, later,
                     write_data=True)
    assert again.reviews.roster.isEmpty()

    # batches become one snapshot of the same rows
    kept = ledger.read("rostered_tbl").count()
    ledger.compact("rostered_tbl")
    assert len(ledger.read("rostered_tbl").inputFiles()) > 0
    assert ledger.read("rostered_tbl").count() == kept


def test_catalog_routes(spark, finished, tmp_path):
    spark.sql(f"CREATE DATABASE routed LOCATION '{tmp_path}'")
    ledger = CatalogLedger(spark, "routed.", S.CATALOG_SCHEMAS)
    for _ in range(2):
        ledgers.route_outputs(ledger, finished.buckets(), S.CATALOG_ROUTES)
    assert ledger.read("exact_matched_resp").count() == finished.main.bucket("exact").count()
    assert ledger.read("no_demo_resp").count() == finished.main.bucket("no_demo").count()
    spark.sql("DROP DATABASE routed CASCADE")


def test_two_runs_of_the_catalog_deployment(spark, inputs, tmp_path):
    """Other tables, history by date, and the sources cut to a day and a case code."""
    spark.sql(f"CREATE DATABASE deployed LOCATION '{tmp_path}/db'")
    config = dataclasses.replace(CONFIG, deployment=S.CATALOG, history_by_date=True,
                                 cutoff="1994-01-01")
    ledger = CatalogLedger(spark, "deployed.", S.CATALOG_SCHEMAS)
    given = runs.Inputs(inputs.submissions.filter("PHLAccessionNumber < 'WA2'"), inputs.fixture("wizard"),
                        inputs.fixture("investigation"), inputs.sheets.filter("false"), inputs.forms)
    first = runs.run(given, ledger, str(tmp_path / "out"), config, write_data=True)
    before = counts(ledger)
    assert before["roster_resp"] == first.roster.select(*S.ROSTER_KEY).distinct().count() > 0
    assert before["fuzzy_review_resp"] and before["exact_matched_resp"] and before["unmatched_resp"]
    runs.run(given, ledger, str(tmp_path / "out"), config, write_data=True)
    assert counts(ledger) == before
    spark.sql("DROP DATABASE deployed CASCADE")


def test_sources_are_read_once(spark, inputs, tmp_path):
    """Every stage after the pull reads what the pull has written."""
    source = staged(inputs.submissions, "source")
    given = [source, inputs.fixture("wizard"), inputs.fixture("investigation")]
    pulled = stages.pull(*given, CONFIG, staged)
    place = source.inputFiles()[0].rsplit("/", 1)[0]
    wrangled = stages.wrangle(pulled, inputs.ledgers["rostered_tbl"], CONFIG, staged)
    main = stages.match(pulled, wrangled, CONFIG, staged)
    for rows in (pulled.submissions, pulled.received, wrangled.checked, main.matched):
        assert not any(f.startswith(place) for f in rows.inputFiles())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_form_rows_are_dealt_out_before_they_are_sorted(spark):
    wide = spark.createDataFrame(
        [(str(n), *([str(n)] * 16)) for n in (1, 2, 2, None, None)],
        ", ".join(["wdrs_case_id string", *(f"{c} string" for c in forms.SLOT_COLUMNS)]))
    out = forms.slot_pivot(forms.form_unpivot(wide))
    plan = _plan(out)  # read from its end: the first step of all stands last
    assert plan.rindex("Exchange hashpartitioning(") > plan.rindex("Sort [")
    assert out.count() == 3 * 4


def test_subtypes_and_history_are_told_without_sorting_rows(inputs):
    both = quality.with_history_and_subtypes(inputs.standardized, inputs.rostered, [])
    assert "SortAggregate" not in _plan(both) and "ShuffledHashJoin" in _plan(both)


def test_ledgers_of_a_run_come_from_one_join(spark, inputs):
    files = {tuple(sorted(rows.inputFiles())) for rows in inputs.ledgers.values()}
    assert len(files) == 1 and not any("lineitem" in f for f in next(iter(files)))
    for name, rows in (("rostered_tbl", inputs.rostered), ("no_match_tbl", inputs.no_match),
                       ("fuzzy_matched_review_tbl", inputs.review_ledger)):
        kept = inputs.ledgers[name]
        assert kept.columns == rows.columns and kept.exceptAll(rows).isEmpty() and rows.exceptAll(kept).isEmpty()


def _odd_submissions(spark):
    """Repeated and missing keys, a rostered submission, several subtypes, missing birth dates."""
    a, b, none = "Influenza A(H3) virus detected by RT-PCR {64}", "Influenza A(H5) virus detected by RT-PCR", "Nothing {60}"
    rows = [("1", "Ann", "Lee", "1/2/1990", a, "51"), ("1", "Anna", "Lee", " 1/2/1990\n", a, "51"),
            ("2", "Bo", "Ray", "1990-02-01", a, "51"), ("2", "Bo", "Ray", "1990-02-01", b, "51"),
            ("3", "Cy", "Fox", "3/3/1993", a, "51"), (None, "Di", "Orr", "4/4/1994", a, "51"),
            (None, "Di", "Orr", "4/4/1994", b, "51"), ("5", "Ed", "Poe", None, a, "51"),
            ("6", "Flo", "Day", "6/6/1996", a, "52"), ("7", "Gus", "Kay", "7/7/1997", none, "51"),
            ("8", "Hal", "May", "8/8/1998", "odd", "51"), ("9", None, None, None, a, "53"), ("9", "Ida", "Ash", "9/9/1999", a, "51")]
    return spark.createDataFrame(
        [(*r, "Nasal Swabs", "some lab", "M1", "2024-01-01", "2024-01-03") for r in rows],
        "PHLAccessionNumber string, PatientFirstName string, PatientLastName string, PatientBirthDate string, "
        "ResultTextConclusion string, TestResult string, SpecimenSource string, SubmitterName string, "
        "SubmitterPatientNumber string, SpecimenDateCollected string, SpecimenDateReceived string")


def _same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("by_date", [False, True])
def test_wide_rows_are_split_without_being_written_again(spark, inputs, by_date):
    labels = []

    def stage(df, label, partition_by=()):
        labels.append(label)
        return staged(df, label, partition_by)

    pulled = stages.pull(
        _odd_submissions(spark), inputs.fixture("wizard"), inputs.fixture("investigation"), CONFIG, staged)
    rostered = spark.createDataFrame([("3", 1, "2024-01-01"), ("1", 2, "2023-01-01"), ("7", None, "2024-01-01")],
                                     f"{KEY} string, CASE_ID bigint, day string").select(
        KEY, "CASE_ID", F.col("day").cast("date").alias("submitted_collection_date"))
    config = dataclasses.replace(CONFIG, history_by_date=by_date)
    out = stages.wrangle(pulled, rostered, config, stage)
    assert "checked" not in labels
    assert keys(out.checked) == {"1", "2", "5", "6", "7", "8", "9", None} - (set() if by_date else {"1"})
    checked = out.checked.filter(~F.col("WDRS_RESULT_SUMMARY").eqNullSafe("G_NEGATIVE"))
    clean = checked.filter(~F.col("qa_flag") & (F.col("WDRS_RESULT") != "G_FLU_ND")).select(*out.clean.columns)
    assert _same_rows(out.clean, clean) and out.clean.count() == (5 if by_date else 3)
    assert _same_rows(out.issues, checked.filter("qa_flag").select(*out.issues.columns))
    assert keys(out.issues) == {"2", "5", "8", "9"}
    assert _same_rows(out.to_link, quality.link_input(out.clean))
    linkable = out.unflagged.join(out.to_link.select(KEY), KEY, "left_semi").select(*out.clean.columns)
    assert _same_rows(linkable, out.clean.filter(F.col(KEY).isNotNull()))
    above, *below = _plan(out.issues).split("Exchange hashpartitioning")
    assert below and "PatientFirstName" not in above


def test_dates_as_text_are_cleaned_once(spark):
    rows = _odd_submissions(spark)
    assert _plan(standardize(rows).select("PatientBirthDate")).count("regexp_replace(PatientBirthDate") <= 2
    days = {r[0] for r in standardize(rows).filter("PHLAccessionNumber = '1'").select("PatientBirthDate").collect()}
    assert days == {dt.date(1990, 1, 2)}


def test_a_run_writes_the_submissions_once(inputs, finished):
    assert sorted(finished.pulled.submissions.inputFiles()) == sorted(inputs.stored_submissions.inputFiles())


def test_persons_are_stored_before_they_are_matched(spark, tmp_path):
    from checks.queries import QUERIES
    spark.createDataFrame([(n, n, dt.date(2024, 1, 1 + n), "1-URGENT", "F") for n in (1, 2, 2, 4)],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_orderpriority string, "
                          "o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(n, k) for n in (1, 2, 4) for k in (1, 2)], "l_orderkey bigint, l_linenumber int").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (4,)], "c_custkey bigint").write.parquet(f"{tmp_path}/customer.parquet")
    best = QUERIES["best_match"](spark, str(tmp_path))
    assert not any(str(tmp_path) in f for f in best.inputFiles())
    assert {r["CASE_ID"] for r in best.collect()} == {100002, 100004}  # an odd order is no lab


def _small_tables(spark, folder):
    """Orders that come twice, without a customer, and of a priority without history; lines of no order."""
    orders = [(1, 1, "1-URGENT", "F"), (2, 2, "2-HIGH", "O"), (2, 2, "2-HIGH", "O"), (3, 3, "5-LOW", "F"),
              (4, None, "2-HIGH", "F"), (6, 2, "3-MEDIUM", "F"), (8, 1, None, "F"), (10, 1, "2-HIGH", None)]
    spark.createDataFrame([(k, c, dt.date(2024, 1, k), p, s) for k, c, p, s in orders],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_orderpriority string, "
                          "o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, n) for k in (1, 2, 2, 3, 4, 6, 8, 9, 10, None) for n in (1, 2)],
                          "l_orderkey bigint, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (3,)], "c_custkey bigint").write.parquet(f"{folder}/customer.parquet")


def test_ledgers_of_a_run_need_no_join_of_submissions(spark, inputs, tmp_path):
    _small_tables(spark, tmp_path)
    try:
        own = type(inputs)(spark, str(tmp_path))
        assert _same_rows(own.stored_submissions, own.submissions) and own.submissions.count() == 20
        plan = _plan(own._stored_records)
        assert "Join" not in plan and "Exchange" not in plan
        for name, rows in (("rostered_tbl", own.rostered), ("no_match_tbl", own.no_match),
                           ("fuzzy_matched_review_tbl", own.review_ledger)):
            assert _same_rows(own.ledgers[name], rows) and not rows.isEmpty()
        assert own.no_match.filter(f"{KEY} = 'WA2'").count() == 16  # two orders, four lines, two of history
    finally:
        type(inputs)(spark, "/root/testdata/sf0.001")  # the views of the other tests


def test_retried_rows_move_once(spark, inputs):
    """Only one row a submission meets what is rostered; wide rows meet the links."""
    labels = []

    def stage(df, label, partition_by=()):
        labels.append(label)
        if label == "rematch_input":
            assert "TEST_RESULT" not in _plan(df)
        return staged(df, label, partition_by)

    ledgers = inputs.ledgers
    extra = ledgers["no_match_tbl"].limit(3).withColumn(KEY, F.lit(None).cast("string"))
    open_rows = ledgers["no_match_tbl"].unionByName(extra)
    some = open_rows.filter("NOT match_found").select(KEY).filter(f"{KEY} LIKE '%1'").distinct().withColumn("CASE_ID", F.lit(1))
    again = stages.rematch(open_rows, some, inputs.stored_with_people, CONFIG, stage)
    assert "history" not in labels
    left = open_rows.filter("NOT match_found").join(some, KEY, "left_anti").filter(f"{KEY} IS NOT NULL")
    assert _same_rows(again.linked.select(KEY, *S.STANDARD_COLUMNS), left.select(KEY, *S.STANDARD_COLUMNS))


def test_record_number_matches_move_rows_once(spark):
    from casebind.operators import mrn
    rows = spark.createDataFrame([(k, *[f"{k}{n}"] * len(S.STANDARD_COLUMNS)) for k in "aab" for n in (1, 1, 2)],
                                 ", ".join(f"{c} string" for c in [KEY, *S.STANDARD_COLUMNS]))
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], f"{KEY} string, CASE_ID bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full = mrn.id_matched_full(pairs, rows, CONFIG.run_date, [])
        assert _plan(full).count("Exchange") == 2  # the rows and the pairs
        assert sorted((r[KEY], r["CASE_ID"], r["WDRS_RESULT"]) for r in full.collect()) == [
            ("a", c, v) for c in (1, 2) for v in ("a1", "a2")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_frames_are_packed_tightly(spark):
    assert all(".zstd." in f for f in staged(spark.range(3), "packed").inputFiles())
