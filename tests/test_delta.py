"""Retries against what is new, and ledgers of which only the touched part is read or written."""

import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casebind.operators import delta, linkage, mrn
from casebind import settings as S
from casebind.plans import stages
from casebind.plans.stages import PullResult
from casebind.settings import LinkConfig
from casebind.sinks import ledgers, outputs
from casebind.sources import tables
from casebind.sources.ledger import BUCKET, CatalogLedger, Ledger, bucket_of
from casebind.sources.staging import counted, staged, staged_and_counted, unstaged
from checks.inputs import CONFIG
from tests.test_linkage import DAY, REF, noisy, plan_of

KEY = "submission_number"


# ---- retries -------------------------------------------------------------------------------

def world(rng):
    names = ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 7))) for _ in range(40)]
    registry = [(i, rng.choice(names), rng.choice(names), DAY, DAY + dt.timedelta(rng.randint(-7, 7)),
                 f"M{i}" if i % 3 == 0 else None, None) for i in range(240)]
    people = [(f"s{i}", *(noisy(rng, n) for n in rng.choice(registry)[1:3]), DAY if i % 9 else None, DAY)
              for i in range(160)]
    ids = [(key, f"M{rng.randrange(260)}") for key, *_ in people if rng.random() < 0.4]
    return registry, people, ids


REGISTRY = REF + ", " + ", ".join(f"{c} string" for c in mrn.MRN_LISTS)
PEOPLE = ("submission_number string, first_name_clean string, last_name_clean string, submitted_dob date, "
          "submitted_collection_date date")


def test_three_retries_equal_the_full_ones(spark):
    """The registry grows and changes, submissions come and are resolved: every retry against what is
    new finds what comparing everything would."""
    rng = random.Random(6)
    registry, people, ids = world(rng)
    link, seen = LinkConfig(), delta.Compared(*(spark.createDataFrame([], s) for s in (
        ", ".join(PEOPLE.split(", ")[1:]),
        "first_name_clean_right string, last_name_clean_right string, ref_dob date, reference_collection_date date, "
        "CASE_ID bigint, last_case_id bigint", "CASE_ID bigint, MRN string", "submission_number string, MRN string")))
    resolved, compared = set(), []
    for step, (cases, came) in enumerate([(100, 60), (170, 110), (240, 160)]):
        today = registry[:cases]
        if step == 2:  # a case changes its name, another goes
            today = [(today[0][0], "changed", *today[0][2:]), *today[2:]]
        ref = spark.createDataFrame(today, REGISTRY)
        refs = linkage.reference_people(ref)
        still = spark.createDataFrame([p for p in people[:came] if p[0] not in resolved], PEOPLE)
        tried = spark.createDataFrame([t for t in ids if t[0] not in resolved and t[0] in {p[0] for p in people[:came]}],
                                      "submission_number string, MRN string")
        found, first_persons, fresh_people = delta.delta_links(still, refs, seen, link, staged)
        full = linkage.link_persons(still, refs, link)
        assert found.exceptAll(full).count() == full.exceptAll(found).count() == 0
        pairs, first_ids, fresh_numbers = delta.delta_number_links(tried, ref, seen, staged)
        all_pairs = mrn.number_pairs(tried, ref)
        assert {tuple(r) for r in pairs.collect()} == {tuple(r) for r in all_pairs.collect()}
        compared.append((first_persons.count(), fresh_people.count(), fresh_numbers.count()))
        resolved |= {r[KEY] for r in still.join(full, linkage.PERSON, "left_semi").collect()}
        resolved |= {r[KEY] for r in all_pairs.collect()}
        seen = delta.Compared(*(staged(a.unionByName(b), "seen") for a, b in (
            (seen.persons, first_persons), (seen.people, fresh_people), (seen.numbers, fresh_numbers),
            (seen.candidates, first_ids))))
    assert resolved and compared[0][1] > compared[1][1] > 0 and compared[1][2] > 0


def test_known_persons_meet_only_new_people(spark):
    """Without new persons the plan reads the difference alone."""
    registry, people, _ = world(random.Random(3))
    still = spark.createDataFrame(people, PEOPLE)
    refs = staged(linkage.reference_people(spark.createDataFrame(registry, REGISTRY)), "all_refs")
    persons = still.filter(linkage.complete()).select(*linkage.PERSON).distinct()
    seen = delta.Compared(staged(persons, "p"), staged(refs.limit(5), "r"), None, None)
    found, first, fresh = delta.delta_links(still, refs, seen, LinkConfig(), staged)
    assert first.isEmpty() and fresh.count() == refs.count() - 5
    place = refs.inputFiles()[0].rsplit("/", 1)[0]
    assert not any(f.startswith(place) for f in found.inputFiles())


# ---- flagged tables ------------------------------------------------------------------------

SCHEMAS = {"no_match_tbl": "submission_number string, n int, match_found boolean",
           "rostered_tbl": ", ".join(f"`{c}` string" for c in outputs.S.CUMULATIVE_COLUMNS),
           "cumulative_roster_snapshot": ", ".join(f"`{c}` string" for c in outputs.S.CUMULATIVE_COLUMNS) + ", through int"}


@pytest.fixture(params=["folder", "catalog"])
def ledger(request, spark, tmp_path):
    if request.param == "folder":
        yield Ledger(spark, str(tmp_path), SCHEMAS, buckets=4)
        return
    spark.sql(f"CREATE DATABASE flagged LOCATION '{tmp_path}'")
    yield CatalogLedger(spark, "flagged.", SCHEMAS, buckets=4)
    spark.sql("DROP DATABASE flagged CASCADE")


def rows_of(ledger, table="no_match_tbl"):
    return sorted((r[KEY] or "", r["n"], r["match_found"]) for r in ledger.read(table).collect())


def keyed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "submission_number string")


def test_resolving_rows_of_a_flagged_table(spark, ledger):
    names = [f"k{i}" for i in range(40)]
    want = {name: False for name in names}
    ledger.insert_if_absent("no_match_tbl", spark.createDataFrame(
        [(n, i, False) for i, n in enumerate(names)] + [(None, 99, False), ("odd", 98, None)], SCHEMAS["no_match_tbl"]))
    for group in (["k3"], ["k4", "k5", "nobody"], names[10:20]):
        assert 0 < ledger.resolve("no_match_tbl", keyed(spark, *group)) <= 4
        want |= {n: True for n in group if n in want}
        assert rows_of(ledger) == sorted([(n, i, want[n]) for i, n in enumerate(names)] + [("", 99, False), ("odd", 98, None)])
        open_names = {r[KEY] for r in ledger.open_rows("no_match_tbl").collect()} - {None}
        assert open_names == {n for n in names if not want[n]}
        ledger.insert_if_absent("no_match_tbl", spark.createDataFrame([("k3", 0, False), ("odd", 0, False)], SCHEMAS["no_match_tbl"]))
    before = rows_of(ledger)
    ledger.compact("no_match_tbl")
    assert rows_of(ledger) == before
    assert ledger.resolve("no_match_tbl", keyed(spark, "k30")) == 1


def test_nothing_resolved_writes_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), SCHEMAS, buckets=4)
    ledger.insert_if_absent("no_match_tbl", spark.createDataFrame([("a", 1, False), ("b", 2, True)], SCHEMAS["no_match_tbl"]))
    assert ledger.resolve("no_match_tbl", keyed(spark, "b", "nobody")) == 0
    assert [p.name for p in sorted((tmp_path / "no_match_tbl").iterdir())] == ["version=v000001-part"]


def test_open_rows_are_read_by_partition(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), SCHEMAS, buckets=4)
    names = [f"k{i}" for i in range(60)]
    ledger.insert_if_absent("no_match_tbl", spark.createDataFrame([(n, 0, False) for n in names], SCHEMAS["no_match_tbl"]))
    ledger.resolve("no_match_tbl", keyed(spark, "k7"))
    bucket = keyed(spark, "k7").select(bucket_of(KEY, 4)).first()[0]
    # only the touched bucket was written, and its older open rows are not read any more
    patch = tmp_path / "no_match_tbl" / "version=v000002-patch"
    assert {p.name for flag in patch.glob("match_found=*") for p in flag.iterdir()} == {f"{BUCKET}={bucket}"}
    rows = ledger.open_rows("no_match_tbl")
    scan = next(line for line in plan_of(rows).splitlines() if "FileScan" in line)
    filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "match_found" in filters and "version" in filters and rows.count() == 59
    # what the scan opens, by partition
    opened = {tuple(r) for r in rows.select(F.input_file_name().alias("f")).distinct().select(
        F.regexp_extract("f", r"version=(v\d+)", 1), F.regexp_extract("f", r"_bucket=(\d)", 1)).collect()}
    assert ("v000001", str(bucket)) not in opened and ("v000002", str(bucket)) in opened and len(opened) == 4


def test_cumulative_roster_keeps_up(spark, ledger):
    columns = outputs.S.CUMULATIVE_COLUMNS
    rng = random.Random(1)
    for step in range(3):
        batch = [tuple([f"s{rng.randrange(30)}" if c == KEY else rng.choice([None, "a", "b", "c"]) for c in columns])
                 for _ in range(25)]
        ledger.append("rostered_tbl", spark.createDataFrame(batch, SCHEMAS["rostered_tbl"]))
        covered = ledger.newest("rostered_tbl") if step else 0
        if step == 1:
            ledger.compact("rostered_tbl")
        got = ledgers.cumulative(ledger, "rostered_tbl")
        want = outputs.cumulative_roster(ledger.read("rostered_tbl"))
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    if not isinstance(ledger, CatalogLedger):
        # only the last batch is left to read
        assert ledger.read("rostered_tbl", covered - 1).count() == 25
        assert ledger.read("rostered_tbl", covered).count() == 0
    assert ledgers.cumulative(ledger, "rostered_tbl").count() == want.count()


# ---- counts on the way ---------------------------------------------------------------------

def test_counts_travel_with_the_write(spark):
    frame = spark.range(10).select((F.col("id") % 3).alias("k"))
    out, told = staged_and_counted(frame, staged, "counted", F.count_if(F.col("k") == 0).alias("zeros"))
    assert told() == {"rows": 10, "zeros": 4} and out.count() == 10
    lazy, told = staged_and_counted(frame, unstaged, "counted", F.count_if(F.col("k") == 0).alias("zeros"))
    assert told() == {"rows": 10, "zeros": 4} and lazy.count() == 10
    empty, told = counted(frame.limit(0))
    empty.write.format("noop").mode("overwrite").save()
    assert told() == {"rows": 0}


def jobs(spark, action):
    spark.sparkContext.setJobGroup("counted-jobs", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted-jobs"))
    action()
    after = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted-jobs"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return after - before


def test_the_guard_starts_no_job(spark, inputs):
    given = inputs.submissions, inputs.fixture("wizard"), inputs.fixture("investigation")
    pulled = stages.pull(*given, CONFIG, staged)
    assert jobs(spark, lambda: stages.require_submissions(pulled)) == 0
    nobody = stages.pull(given[0].limit(0), *given[1:], CONFIG, staged)
    with pytest.raises(ValueError):
        stages.require_submissions(nobody)
    assert isinstance(pulled, PullResult) and pulled.told()["rows"] == given[0].count()


def test_registry_sources_are_read_once(spark, inputs):
    """Cases, labs and what is derived from them come from what the pull wrote."""
    sources = [staged(inputs.fixture(n), n) for n in ("wizard", "investigation")]
    places = [s.inputFiles()[0].rsplit("/", 1)[0] for s in sources]
    reads = []

    def stage(df, label, partition_by=()):
        reads.append((label, [any(f.startswith(p) for f in df.inputFiles()) for p in places]))
        return staged(df, label, partition_by)

    pulled = stages.pull(inputs.submissions, *sources, CONFIG, stage)
    assert [label for label, hit in reads if hit[0]] == ["cases"] and [label for label, hit in reads if hit[1]] == ["labs"]
    for frame in (pulled.registry, pulled.cases, pulled.people):
        assert not any(f.startswith(p) for f in frame.inputFiles() for p in places)
    lazy = stages.pull(inputs.submissions, *sources, CONFIG)
    assert lazy.registry.exceptAll(pulled.registry).count() == pulled.registry.exceptAll(lazy.registry).count() == 0


# ---- receipts ------------------------------------------------------------------------------

def test_receipts_of_changing_columns(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), S.VARIANT_SCHEMAS)
    runs = [spark.createDataFrame([("1", dt.date(2024, 1, 2), 3, "x")], "k string, day date, n int, `odd.\"name` string"),
            spark.createDataFrame([("2", "y", 2.5), (None, None, None)], "k string, extra string, n double")]
    for rows in [*runs, runs[0]]:
        receipt = tables.receipt_as_variant(tables.raw_receipt(rows, "k", dt.date(2024, 6, 1)))
        ledger.insert_if_absent("received_submissions", receipt.filter("submission_number IS NOT NULL"))
    stored = ledger.read("received_submissions")
    assert stored.count() == 2 and "variant" in dict(stored.dtypes).values()
    got = {r[KEY]: r.asDict() for r in tables.variant_unnest(stored).collect()}
    assert got["1"] == {KEY: "1", "internal_create_date": dt.date(2024, 6, 1), "k": "1", "day": dt.date(2024, 1, 2),
                        "n": got["1"]["n"], 'odd."name': "x", "extra": None}
    assert float(got["1"]["n"]) == 3 and float(got["2"]["n"]) == 2.5 and got["2"]["extra"] == "y" and got["2"]["day"] is None
    assert tables.variant_unnest(stored, {"day": "date"}).columns == ["day", "internal_create_date", KEY]
    assert tables.variant_columns(stored.limit(0)) == {}


# ---- review sheets -------------------------------------------------------------------------

def test_lines_that_are_no_review_rows(spark, tmp_path):
    columns = [f.name for f in tables.review_csv(spark, f"{tmp_path}/none/*.csv").schema]
    (tmp_path / "done").mkdir()

    def line(**values):
        return ",".join(values.get(c, "") for c in columns)

    good = line(submission_number="a", CASE_ID="7", submitted_dob="1990-01-02", good_match="true")
    bad = [line(submission_number="b", CASE_ID="7", submitted_dob="1/2/1990"), line(submission_number="c", CASE_ID="seven"),
           line(submission_number="d", good_match="maybe"), "e,only,three"]
    (tmp_path / "done" / "one.csv").write_text("\n".join([",".join(columns), good, *bad[:2]]) + "\n")
    (tmp_path / "done" / "two.csv").write_text("\n".join([",".join(columns), *bad[2:]]) + "\n")
    rows, rejects = tables.review_sheets(spark, f"{tmp_path}/done/*.csv")
    assert [(r[KEY], r["CASE_ID"], r["submitted_dob"]) for r in rows.collect()] == [("a", 7, dt.date(1990, 1, 2))]
    told = {(r["file"].rsplit("/", 1)[1], r[tables.REJECT]) for r in rejects.collect()}
    assert told == {("one.csv", bad[0]), ("one.csv", bad[1]), ("two.csv", bad[2]), ("two.csv", bad[3])}
    assert tables.review_sheets(spark, f"{tmp_path}/none/*.csv")[1].count() == 0
    assert dataclasses.is_dataclass(PullResult)
