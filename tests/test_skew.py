"""Hot keys are found, spread, and never change a result."""

import pytest
from pyspark.sql import functions as F

from casebind.operators.history import absent_rows
from casebind.operators.skew import hot_keys, lookup_join
from casebind.sources.tables import ref_assemble


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a sixth without a key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(
        F.concat(F.lit("k"), "id"))
    return spark.range(0, 12000, numPartitions=6).select(key.alias("k"), "id", F.lit(1).alias("same"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 5), ("zzz", 9), (None, 0)], "k string, v int")


def test_hot_keys(facts):
    found = hot_keys(facts, ["k"])
    assert len(found) == 1 and found[0][1] == 3  # a third of 8 partitions, rounded up
    assert hot_keys(facts.filter("k <> 'hot'"), ["k"]) == []


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(facts, lookup, how):
    plain = facts.join(lookup, ["k"], how)
    spread = lookup_join(facts, lookup, ["k"], how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0
    assert spread.count() == plain.count()


def test_several_lookup_rows_per_key(facts, spark):
    many = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3)], "k string, v int")
    plain, spread = facts.join(many, ["k"]), lookup_join(facts, many, ["k"], "inner")
    assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count()


def test_hot_and_null_keys_reach_several_tasks(facts, lookup):
    salted = lookup_join(facts, lookup, ["k"], "left")
    spark = facts.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = lookup_join(facts, lookup, ["k"], "left")
        tasks = salted.withColumn("task", F.spark_partition_id()).groupBy("k").agg(
            F.countDistinct("task").alias("tasks")).filter("k = 'hot' OR k IS NULL")
        assert all(row["tasks"] > 1 for row in tasks.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_keys_of_unequal_type(spark, how, kind):
    """Key 7 on three quarters of the facts, an int there and something else in the lookup."""
    facts = spark.range(4000).select(
        F.when(F.col("id") % 4 < 3, 7).otherwise(F.col("id")).cast("int").alias("k"), "id")
    lookup = spark.range(0, 4000, 7).select(F.col("id").cast(kind).alias("k"), (F.col("id") * 2).alias("v"))
    plain, spread = facts.join(lookup, ["k"], how), lookup_join(facts, lookup, ["k"], how)
    same = [F.col("k").cast("string"), *plain.columns[1:]]
    plain, spread = plain.select(*same), spread.select(*same)
    assert plain.count() == spread.count()
    assert spread.exceptAll(plain).count() == 0
    # hot keys found before the types met are looked for anew
    again = lookup_join(facts, lookup, ["k"], how, hot_keys(facts, ["k"])).select(*same)
    assert again.exceptAll(plain).count() == 0 and again.count() == plain.count()


def test_rows_absent_from_a_target_of_another_type(spark):
    batch = spark.range(4000).select(
        F.when(F.col("id") % 4 < 3, 7).otherwise(F.col("id")).cast("int").alias("submission_number"))
    target = spark.createDataFrame([("7",)], "submission_number string")
    assert absent_rows(batch, target).count() == 999  # id 7 is a 7 as well


def test_a_case_with_a_third_of_all_labs(spark):
    wizard = spark.range(1000).select(F.col("id").alias("CASE_ID"), F.lit("x").alias("CODE"))
    labs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("CASE_ID"),
        F.col("id").alias("SPECIMEN__COLLECTION__DTTM"), F.lit("y").alias("CODE"))
    got = ref_assemble(wizard, labs)
    want = wizard.join(labs.withColumnRenamed("CODE", "CODE_right"), "CASE_ID", "left")
    assert got.columns == ["CASE_ID", "CODE", "SPECIMEN_COLLECTION_DTTM", "CODE_right"]
    rows = got.count()
    assert rows == want.count() and got.distinct().count() == rows
    assert got.toDF(*want.columns).exceptAll(want).count() == 0


def test_absent_rows_bring_only_what_is_read(facts, lookup):
    """No hash of columns that nobody reads decides where rows without a key go."""
    spark = facts.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wide = lookup_join(facts.withColumn("text", F.concat(F.lit("wide"), "id")), lookup, ["k"], "left", [])
        rows = absent_rows(wide, lookup, ["k"], [])
        plan = rows.select("k")._jdf.queryExecution().executedPlan().toString()
        above, *below = plan.split("Exchange hashpartitioning(k")
        assert below and "text#" not in above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    spread = absent_rows(facts, lookup, ["k"])
    assert spread.exceptAll(facts.join(lookup, ["k"], "left_anti")).isEmpty()
    assert spread.filter("k IS NULL").count() == 2000
