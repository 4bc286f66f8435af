"""Ledger writes: repeatable, typed, and safe when a write dies half-way."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casebind.operators import frames
from casebind.operators.history import absent_rows, flag_resolved
from casebind.sources import tables
from casebind.sources.key_index import Batch
from casebind.sources.ledger import CatalogLedger, Ledger

SCHEMAS = {"t": "submission_number string, n int, match_found boolean"}


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "submission_number string, n int, match_found boolean")


def contents(ledger):
    return sorted((r["submission_number"] or "", r["n"], r["match_found"]) for r in ledger.read("t").collect())


@pytest.fixture(params=["folder", "catalog"])
def ledger(request, spark, tmp_path):
    if request.param == "folder":
        yield Ledger(spark, str(tmp_path), SCHEMAS)
        return
    spark.sql(f"CREATE DATABASE ledger_test LOCATION '{tmp_path}'")
    yield CatalogLedger(spark, "ledger_test.", SCHEMAS)
    spark.sql("DROP DATABASE ledger_test CASCADE")


def test_inserting_twice_adds_nothing(spark, ledger):
    assert contents(ledger) == []
    rows = batch(spark, ("a", 1, False), ("a", 2, False), (None, 3, False))
    ledger.insert_if_absent("t", rows)
    assert contents(ledger) == [("", 3, False), ("a", 1, False), ("a", 2, False)]
    ledger.insert_if_absent("t", batch(spark, ("a", 9, False), ("b", 4, False)))
    assert contents(ledger) == [("", 3, False), ("a", 1, False), ("a", 2, False), ("b", 4, False)]


def test_replace_may_read_the_table_itself(spark, ledger):
    ledger.insert_if_absent("t", batch(spark, ("a", 1, False), ("b", 2, False), ("c", 3, True)))
    ledger.replace("t", flag_resolved(ledger.read("t"), batch(spark, ("b", 0, None))))
    assert contents(ledger) == [("a", 1, False), ("b", 2, True), ("c", 3, True)]
    ledger.insert_if_absent("t", batch(spark, ("d", 4, False)))
    assert len(contents(ledger)) == 4


def test_unfinished_writes_do_not_count(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), SCHEMAS)
    ledger.insert_if_absent("t", batch(spark, ("a", 1, False)))
    dead = Path(tmp_path) / "t" / "v000002-full"
    dead.mkdir()
    (dead / "part-0.parquet").write_bytes(b"half a file")
    assert contents(ledger) == [("a", 1, False)]
    ledger.insert_if_absent("t", batch(spark, ("b", 2, False)))
    assert contents(ledger) == [("a", 1, False), ("b", 2, False)]
    assert (Path(tmp_path) / "t" / "v000003-part" / "_SUCCESS").exists()


def numbered(spark, *numbers):
    return batch(spark, *[(f"s{n:06d}", n, False) for n in numbers])


def opened(frame):
    return {tuple(r[0].rsplit("/", 3)[1:3]) for r in frame.select(F.input_file_name()).distinct().collect()}


def test_what_an_insert_reads_follows_its_batch(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), SCHEMAS)
    for day in range(4):
        assert ledger.insert_if_absent("t", numbered(spark, *range(500 * day, 500 * day + 500))) == 500
    few = Batch(numbered(spark, 3, 1700, 9999), ["submission_number"])
    known = ledger._known("t", few)
    assert len(few.buckets) <= 3 and {b for _, b in opened(known)} == {f"_key_bucket={b}" for b in few.buckets}
    assert {v for v, _ in opened(known)} == {"v000001", "v000002", "v000003", "v000004"}
    assert sorted(r[0] for r in few.among(known).collect()) == ["s000003", "s001700"]
    late = Batch(numbered(spark, *range(1900, 2100)), ["submission_number"])
    met = late.among(ledger._known("t", late))
    plan = met._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(submission_number,s001900)" in plan and "BroadcastHashJoin" in plan
    assert met.count() == 100
    assert ledger.insert_if_absent("t", numbered(spark, *range(1900, 2100))) == 100
    assert ledger.insert_if_absent("t", numbered(spark, *range(1900, 2100))) == 0
    assert len(contents(ledger)) == 2100


def test_the_index_catches_up_with_dead_runs_snapshots_and_patches(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), SCHEMAS, flagged=["t"], buckets=4)
    rows = numbered(spark, 1, 2, 3)
    ledger.append("t", rows)
    assert ledger.insert_if_absent("t", rows.unionByName(numbered(spark, 4))) == 1
    index = Path(tmp_path) / "t" / "_keys" / "submission_number"
    assert sorted(p.name for p in index.iterdir()) == ["v000001"]
    dead = index / "v000002"  # an index write that died
    dead.mkdir()
    (dead / "part-0.parquet").write_bytes(b"half a file")
    assert ledger.insert_if_absent("t", numbered(spark, 4, 5)) == 1
    assert ledger.resolve("t", numbered(spark, 2, 5)) > 0
    assert ledger.insert_if_absent("t", numbered(spark, 1, 2, 3, 4, 5)) == 0
    ledger.compact("t")
    assert ledger.insert_if_absent("t", numbered(spark, 2, 5, 6)) == 1
    ledger.replace("t", numbered(spark, 7))
    assert ledger.insert_if_absent("t", numbered(spark, 1, 7)) == 1  # what a snapshot left out is absent again
    assert contents(ledger) == [("s000001", 1, False), ("s000007", 7, False)]


def test_inserts_by_several_columns_with_nulls(spark, ledger):
    on = ["submission_number", "n"]
    rows = batch(spark, ("a", 1, None), ("a", None, None), (None, 1, None), ("b", 1, None))
    assert ledger.insert_if_absent("t", rows, on) == 4
    assert ledger.insert_if_absent("t", rows, on) == 2  # a key with a null in it equals none
    assert ledger.insert_if_absent("t", batch(spark, (None, 1, None)), on) == 1
    assert ledger.insert_if_absent("t", batch(spark), on) == 0
    assert ledger.insert_if_absent("t", batch(spark, ("a", 2, None), ("b", 1, True)), on) == 1


def test_null_keys_are_always_absent(spark):
    rows = absent_rows(batch(spark, (None, 1, None), ("a", 2, None)), batch(spark, (None, 0, None), ("a", 0, None)))
    assert [r["n"] for r in rows.collect()] == [1]


def test_align_schema(spark):
    empty = spark.createDataFrame([], "other int")
    assert frames.align_schema(empty, "hi string").columns == ["hi"]
    row = frames.align_schema(spark.createDataFrame([("7", "x")], "n string, extra string"), "m date, n int").first()
    assert row.asDict() == {"m": None, "n": 7}


def test_keep_one_is_a_total_order(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", None, "z"), ("a", 1, "y"), ("b", 3, None)],
                                 "k string, n int, `p.q` string")
    got = sorted(tuple(r) for r in frames.keep_one(rows, ["k"]).collect())
    assert got == [("a", None, "z"), ("b", 3, None)]
    assert frames.keep_one(rows, ["k"]).columns == ["k", "n", "p.q"]
    assert frames.keep_one(rows.repartition(5), ["k"], ["p.q"]).filter("k = 'a'").first()["n"] == 2


def test_unions_and_column_patterns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    out = frames.union_diagonal(a, b)
    assert out.columns == ["a", "b", "c"] and out.count() == 2
    assert frames.columns_matching(out, "^[ab]$", exclude="b") == ["a"]
    assert frames.columns_matching(out, dtype="double") == ["c"]
    dated = spark.createDataFrame([(dt.date(2024, 3, 1),)], "d date")
    assert frames.dates_as_text(dated, "MM/dd/yyyy").first()["d"] == "03/01/2024"


def test_review_sheets(spark, tmp_path):
    assert tables.review_csv(spark, f"{tmp_path}/none/*.csv").count() == 0
    done = Path(tmp_path) / "done"
    done.mkdir()
    columns = [f.name for f in tables.review_csv(spark, f"{tmp_path}/none/*.csv").schema]
    for name in ("a", "b"):
        values = {"submission_number": name, "CASE_ID": "7", "good_match": "true", "submitted_dob": "1990-01-02"}
        (done / f"{name}.csv").write_text(
            ",".join(columns) + "\n" + ",".join(values.get(c, "") for c in columns) + "\n")
    rows = tables.review_csv(spark, f"{done}/*.csv").collect()
    assert sorted((r["submission_number"], r["CASE_ID"], r["good_match"]) for r in rows) == [("a", 7, True), ("b", 7, True)]
    assert rows[0]["submitted_dob"] == dt.date(1990, 1, 2)


def test_receipt_round_trip(spark, inputs):
    raw = inputs.submissions
    receipt = tables.raw_receipt(raw, "PHLAccessionNumber", dt.date(2024, 6, 1))
    nested = tables.receipt_unnest(receipt)
    stored = tables.receipt_unnest(tables.receipt_as_json(receipt), raw.schema)
    assert nested.columns == sorted(raw.columns + ["submission_number", "internal_create_date"])
    assert stored.exceptAll(nested).count() == nested.exceptAll(stored).count() == 0


def test_clashing_registry_columns(spark):
    wizard = spark.createDataFrame([(1, "F"), (2, "F")], "CASE_ID bigint, CODE string")
    labs = spark.createDataFrame([(1, "G", dt.date(2024, 1, 1))],
                                 "CASE_ID bigint, CODE string, SPECIMEN__COLLECTION__DTTM date")
    rows = tables.ref_assemble(wizard, labs)
    assert rows.columns == ["CASE_ID", "CODE", "CODE_right", "SPECIMEN_COLLECTION_DTTM"]
    assert rows.filter(F.col("CODE_right").isNull()).count() == 1
