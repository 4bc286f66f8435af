"""Linkage against brute force, and its behaviour under skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casebind.operators import linkage as L
from casebind.settings import LinkConfig

DAY = dt.date(2024, 1, 10)
SRC = "submission_number string, PatientFirstName string, PatientLastName string, PatientBirthDate date, SpecimenDateCollected date"
REF = "CASE_ID bigint, FIRST_NAME string, LAST_NAME string, BIRTH_DATE date, SPECIMEN_COLLECTION_DTTM date"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def score(a, b):
    return (1 - edits(a, b) / max(len(a), len(b))) * 100


def brute(src, ref, threshold, window=5):
    out = {}
    for key, first, last, dob, day in src:
        if not (first and last and dob and day):
            out[key] = ("no_demo", None)
            continue
        good = []
        for case, rf, rl, rdob, rday in ref:
            if rdob == dob and rday and abs((rday - day).days) <= window:
                direct, swapped = score(first + last, rf + rl), score(first + last, rl + rf)
                if max(direct, swapped) >= threshold - 1e-9:
                    good.append(((first, last) == (rf, rl), case))
        if not good:
            out[key] = ("unmatched", None)
            continue
        same = {case for equal, case in good if equal}
        out[key] = ("exact", same.pop()) if len(same) == 1 else ("fuzzy", None)
    return out


def noisy(rng, name):
    letters = list(name)
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
        kind, at = rng.choice("sid"), rng.randrange(len(letters)) if letters else 0
        if kind == "s" and letters:
            letters[at] = rng.choice("abc")
        elif kind == "i":
            letters.insert(at, rng.choice("abc"))
        elif letters:
            letters.pop(at)
    return "".join(letters)


@pytest.mark.parametrize("threshold", [55, 70, 80, 90, 100])
def test_segments_miss_no_pair(spark, threshold):
    """Short names over few letters: many near pairs of every length."""
    rng = random.Random(threshold)
    names = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(24)]
    ref = [(i, rng.choice(names), rng.choice(names), DAY, DAY + dt.timedelta(rng.randint(-9, 9)))
           for i in range(60)]
    src = []
    for i in range(150):
        _, f, l, _, _ = rng.choice(ref)
        if rng.random() < 0.2:
            f, l = l, f
        src.append((f"s{i}", noisy(rng, f), noisy(rng, l), DAY if rng.random() < 0.95 else None, DAY))
    got = L.demographic_link(
        spark.createDataFrame(src, SRC), spark.createDataFrame(ref, REF),
        LinkConfig(threshold=threshold), carry=[]).rows.collect()
    want = brute(src, ref, threshold)
    assert {r["submission_number"]: r["bucket"] for r in got} == {k: v[0] for k, v in want.items()}
    assert {r["submission_number"]: r["CASE_ID"] for r in got if r["bucket"] == "exact"} == {
        k: v[1] for k, v in want.items() if v[0] == "exact"}


def test_low_thresholds_compare_whole_blocks(spark):
    src = [("s1", "ab", "cd", DAY, DAY)]
    ref = [(1, "xy", "cd", DAY, DAY), (2, "xy", "zz", DAY, DAY)]
    row = L.demographic_link(spark.createDataFrame(src, SRC), spark.createDataFrame(ref, REF),
                             LinkConfig(threshold=50), carry=[]).rows.first()
    assert (row["bucket"], row["CASE_ID"], row["match_ratio"]) == ("fuzzy", 1, 50.0)


@pytest.mark.parametrize("threshold", [51, 60, 67, 75, 80, 85, 92, 100])
def test_probes_meet_every_near_name(spark, threshold):
    """Key against key: all pairs of short names over two letters, of every length and shift."""
    rng = random.Random(threshold)
    names = list({"".join(rng.choice("ab") for _ in range(rng.randint(1, 14))) for _ in range(160)})
    frame = spark.createDataFrame([(n,) for n in names], "name string").select(
        "name", F.lit(DAY).alias("ref_dob"), F.lit(1).alias("slot"))
    lengths = F.array(*[F.lit(n) for n in sorted({len(n) for n in names})])
    right = frame.select(F.col("name").alias("b"), F.explode(L.index_keys(F.col("name"), threshold)).alias("key"))
    left = frame.select(F.col("name").alias("a"), F.explode(L.probe_keys(F.col("name"), lengths, threshold)).alias("key"))
    met = {tuple(r) for r in left.join(right, "key").select("a", "b").distinct().collect()}
    near = {(a, b) for a in names for b in names if score(a, b) >= threshold - 1e-9}
    assert near <= met


def test_segments_spare_comparisons(spark):
    """On one birth date of many similar names: far fewer rows meet than over letter triples."""
    rng = random.Random(2)
    syllables = ["ma", "ri", "an", "jo", "el", "le", "na", "ro", "ta", "si", "ko", "ber", "son", "man", "ley", "ton"]

    def name():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))

    ref = [(i, name(), name(), DAY, DAY) for i in range(1500)]
    src = [(f"s{i}", name(), noisy(rng, ref[i][2]), DAY, DAY) for i in range(1500)]
    persons = L.people(spark.createDataFrame(src, SRC), carry=[]).filter(L.complete()).select(*L.PERSON).distinct()
    refs = L.reference_people(spark.createDataFrame(ref, REF))
    link = LinkConfig()
    compared = L.segment_matches(persons, refs, link).count()
    full = {(a, b) for a, b in {(r["first_name_clean"], r["last_name_clean"]) for r in persons.collect()}}
    others = [(a, b) for _, a, b, _, _ in ref]
    triples = {}
    for f, l in others:
        for n in {f + l, l + f}:
            for i in range(len(n) * 20 // 80 + 1):
                triple = (n + "$$")[3 * i:3 * i + 3]
                triples[triple] = triples.get(triple, 0) + 1
    by_triples = sum(triples.get((f + l + "$$")[at:at + 3], 0) for f, l in full for at in range(len(f + l)))
    assert compared * 8 < by_triples


def test_buckets(spark):
    src = [
        ("one", "Ann", "Lee", DAY, DAY), ("swap", "Lee", "Ann", DAY, DAY),
        ("typo", "Anna", "Lee", DAY, DAY), ("tie", "Bob", "Ray", DAY, DAY),
        ("late", "Ann", "Lee", DAY, DAY + dt.timedelta(6)), ("none", "Zed", "Qux", DAY, DAY),
        ("digits", "123", "Lee", DAY, DAY), ("nodate", "Ann", "Lee", DAY, None),
    ]
    ref = [(1, "ANN", "LEE", DAY, DAY), (1, "ANN", "LEE", DAY, DAY - dt.timedelta(2)),
           (2, "Bob", "Ray", DAY, DAY), (3, "Bob", "Ray", DAY, DAY)]
    rows = {r["submission_number"]: r for r in L.demographic_link(
        spark.createDataFrame(src, SRC), spark.createDataFrame(ref, REF), carry=[]).rows.collect()}
    assert {k: r["bucket"] for k, r in rows.items()} == {
        "one": "exact", "swap": "fuzzy", "typo": "fuzzy", "tie": "fuzzy", "late": "unmatched",
        "none": "unmatched", "digits": "no_demo", "nodate": "no_demo"}
    assert rows["one"]["CASE_ID"] == 1 and rows["one"]["reference_collection_date"] == DAY
    assert rows["tie"]["CASE_ID"] == 2 and rows["tie"]["match_ratio"] == 100
    assert rows["swap"]["reverse_match_ratio"] == 100


def test_names_of_any_script(spark):
    """Letters stay whatever their script; names that are equal only when glued are not exact."""
    src = [("acc", "José", "Núñez", DAY, DAY), ("cyr", "Иван", "Петров", DAY, DAY),
           ("han", "李", "小龙", DAY, DAY), ("glued", "Jo Annlee", "Smith", DAY, DAY),
           ("glued2", "Jo", "Annlee", DAY, DAY)]
    ref = [(1, "JOSÉ", "NÚÑEZ", DAY, DAY), (2, "ИВАН", "Петров ", DAY, DAY), (3, "李", "小龙", DAY, DAY),
           (4, "Joann", "Lee", DAY, DAY)]
    rows = {r["submission_number"]: (r["bucket"], r["CASE_ID"], r["match_ratio"]) for r in L.demographic_link(
        spark.createDataFrame(src, SRC), spark.createDataFrame(ref, REF), carry=[]).rows.collect()}
    assert rows == {"acc": ("exact", 1, 100.0), "cyr": ("exact", 2, 100.0), "han": ("exact", 3, 100.0),
                    "glued": ("unmatched", None, None), "glued2": ("fuzzy", 4, 100.0)}


def test_many_on_one_birth_date(spark):
    """Thousands of persons and references share a placeholder date: the pairs are still found,
    through joins that can be split on either side."""
    letters = F.translate(F.lpad("id", 5, "0"), "0123456789", "abcdefghij")
    name = F.concat(letters, F.translate(F.reverse(F.lpad("id", 5, "0")), "0123456789", "klmnopqrst"))
    ref = spark.range(3000).select(
        F.col("id").alias("CASE_ID"), name.alias("FIRST_NAME"), F.lit("x").alias("LAST_NAME"),
        F.lit(DAY).alias("BIRTH_DATE"), F.lit(DAY).alias("SPECIMEN_COLLECTION_DTTM"))
    src = ref.select(
        F.col("CASE_ID").cast("string").alias("submission_number"),
        F.concat("FIRST_NAME", F.lit("z")).alias("PatientFirstName"), F.lit("x").alias("PatientLastName"),
        F.lit(DAY).alias("PatientBirthDate"), F.lit(DAY).alias("SpecimenDateCollected"))
    linked = L.demographic_link(src, ref, carry=[]).rows
    assert linked.filter("bucket = 'fuzzy' AND CASE_ID = CAST(submission_number AS BIGINT)").count() == 3000
    persons = L.people(src, carry=[])
    pairs = L.similar_pairs(persons, L.reference_people(ref), LinkConfig())
    # outer joins are only those with the broadcast list of hot blocks
    assert all("Broadcast" in line for line in plan_of(pairs).splitlines() if "LeftOuter" in line)


def test_copies_do_not_multiply_pairs(spark):
    """A third of both sides is one person: it is still one pair to compare."""
    src = spark.range(3000).select(
        F.concat(F.lit("s"), "id").alias("submission_number"),
        F.when(F.col("id") % 3 == 0, "test").otherwise(F.concat(F.lit("n"), F.translate("id", "0123456789", "abcdefghij")))
        .alias("PatientFirstName"), F.lit("case").alias("PatientLastName"),
        F.lit(DAY).alias("PatientBirthDate"), F.lit(DAY).alias("SpecimenDateCollected"))
    ref = spark.range(3000).select(
        F.col("id").alias("CASE_ID"), F.lit("test").alias("FIRST_NAME"), F.lit("case").alias("LAST_NAME"),
        F.lit(DAY).alias("BIRTH_DATE"), F.lit(DAY).alias("SPECIMEN_COLLECTION_DTTM"))
    refs = L.reference_people(ref)
    assert refs.count() == 1
    rows = L.demographic_link(src, ref, carry=[]).rows
    got = {r["bucket"]: (r["n"], r["low"], r["high"]) for r in rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("CASE_ID").alias("low"), F.max("CASE_ID").alias("high")).collect()}
    assert got["fuzzy"] == (1000, 0, 0)
    assert sum(n for n, _, _ in got.values()) == 3000


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_plan_has_no_product_and_no_python(inputs):
    plan = plan_of(inputs.matched.combined_roster)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Window"):
        assert bad not in plan


@pytest.mark.parametrize("threshold", [55, 80, 100])
def test_small_and_large_blocks_give_the_same_pairs(spark, monkeypatch, threshold):
    """Blocks compared one by one, through the segment index, and some either way."""
    rng = random.Random(threshold)

    def name():
        return "".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))

    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(40)]
    born = [dt.date(1990, 1, 1), dt.date(1991, 1, 1)]
    ref = [(i, name(), name(), rng.choice(born), rng.choice(days)) for i in range(150)]
    src = [(f"s{i}", noisy(rng, f) or "a", noisy(rng, g) or "b", b, d + dt.timedelta(rng.randint(-7, 7)))
           for i, f, g, b, d in ref]
    persons = L.people(spark.createDataFrame(src, SRC), carry=[]).filter(L.complete()).select(*L.PERSON).distinct()
    refs, link = L.reference_people(spark.createDataFrame(ref, REF)), LinkConfig(threshold)
    want = {tuple(r) for r in L.segment_pairs(persons, refs, link).collect()}
    sizes = sorted(r["count"] for r in refs.groupBy("ref_dob", L._slot(F.col("reference_collection_date"), 5)).count().collect())
    middle = sizes[len(sizes) // 2 - 1]
    assert middle < sizes[-1] and want
    for few in (0, middle, 1000):
        monkeypatch.setattr(L, "FEW", few)
        assert {tuple(r) for r in L.similar_pairs(persons, refs, link).collect()} == want


def test_a_reference_of_a_small_block_moves_once(spark):
    """Neither cut into segments nor copied to the slots near it."""
    ref = [(i, "ann", f"lee{i}", DAY, DAY + dt.timedelta(i)) for i in range(40)]
    src = [(f"s{i}", "ann", f"leo{i}", DAY, DAY + dt.timedelta(i)) for i in range(40)]
    persons = L.people(spark.createDataFrame(src, SRC), carry=[]).select(*L.PERSON).distinct()
    pairs = L.similar_pairs(persons, L.reference_people(spark.createDataFrame(ref, REF)), LinkConfig(), [])
    assert plan_of(pairs).count("Generate explode") == 1  # the persons, to the slots of their window
    assert pairs.count() >= 40


def test_equal_names_meet_in_wide_slots(spark):
    """Few references are copied to two slots, and a pair across the end of one is found."""
    ref = [(i, "ann", "lee", DAY, DAY + dt.timedelta(3 * i)) for i in range(300)]
    src = [(f"s{i}", "ann", "lee", DAY, DAY + dt.timedelta(3 * i + 5)) for i in range(300)]
    persons = L.people(spark.createDataFrame(src, SRC), carry=[]).select(*L.PERSON).distinct()
    refs = L.reference_people(spark.createDataFrame(ref, REF))
    assert L._by_slot(refs, LinkConfig(), L.WIDE).count() < 1.2 * 300
    got = {(r["submitted_collection_date"], r["reference_collection_date"])
           for r in L.exact_pairs(persons, refs, LinkConfig()).collect()}
    assert got == {(s[4], r[4]) for s in src for r in ref if abs((s[4] - r[4]).days) <= 5}
