"""The test inputs as Spark frames."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions.text import name_clean
from casebind.operators import linkage
from casebind.operators.frames import keep_one
from casebind.operators.standardize import standardize
from casebind.plans import run, stages
from casebind.settings import EngineConfig
from casebind.sources.staging import staged
from casebind.sources.tables import raw_receipt, receipt_unnest, ref_assemble
from checks.fixtures import BASE_TABLES, RUN_DATE, spark_sql, submissions_with_history

CONFIG = EngineConfig(run_date=RUN_DATE)


class Inputs:
    """Frames over one test directory, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        for table in BASE_TABLES:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)

    def fixture(self, name: str) -> DataFrame:
        return self.spark.sql(spark_sql(name))

    @cached_property
    def submissions(self) -> DataFrame:
        return self.fixture("submissions")

    @cached_property
    def registry(self) -> DataFrame:
        return ref_assemble(self.fixture("wizard"), self.fixture("investigation"))

    @cached_property
    def forms(self) -> DataFrame:
        return self.fixture("form_records")

    @cached_property
    def pulled(self) -> stages.PullResult:
        return stages.pull(
            self.submissions, self.fixture("wizard"), self.fixture("investigation"), CONFIG)

    @cached_property
    def _submissions_and_history(self) -> DataFrame:
        """The submissions, each with its history, written once for whatever reads them several times."""
        return staged(self.spark.sql(submissions_with_history()), "submissions")

    @cached_property
    def stored_submissions(self) -> DataFrame:
        return self._submissions_and_history.drop("history")

    @cached_property
    def stored(self) -> stages.PullResult:
        """As ``pulled``, over what is written; stages that read it several times start here."""
        return stages.pull(
            self.stored_submissions, self.fixture("wizard"), self.fixture("investigation"), CONFIG)

    @cached_property
    def stored_with_people(self) -> stages.PullResult:
        return dataclasses.replace(self.stored, people=staged(self.stored.people, "people"))

    @cached_property
    def standardized(self) -> DataFrame:
        return standardize(self.pulled.submissions)

    @staticmethod
    def _recorded(submissions: DataFrame) -> DataFrame:
        """Submissions that have met their history, as an earlier run would have recorded them,
        with their true case.

        Raw rows are narrower than standardized ones, and those that meet no history need not be
        standardized.
        """
        return standardize(submissions).select(
            "submission_number", "internal_create_date", "CASE_ID",
            name_clean(F.col("PatientFirstName")).alias("first_name_clean"),
            name_clean(F.col("PatientLastName")).alias("last_name_clean"),
            F.col("PatientBirthDate").alias("submitted_dob"),
            F.col("SpecimenDateCollected").alias("submitted_collection_date"),
            "reference_collection_date", *S.STANDARD_COLUMNS, "match_found", "priority")

    @property
    def _stored_records(self) -> DataFrame:
        """What is recorded of the stored submissions, which lie with their history: no join."""
        met = self._submissions_and_history.select("*", F.inline("history")).drop("history")
        return self._recorded(receipt_unnest(raw_receipt(met, CONFIG.primary_key, CONFIG.run_date)))

    def _ledger(self, priority: str) -> DataFrame:
        history = self.fixture("history").filter(F.col("priority") == priority)
        return self._recorded(self.pulled.submissions.join(history, "submission_number")).drop("priority")

    @cached_property
    def rostered(self) -> DataFrame:
        return self._ledger("1-URGENT").drop("match_found")

    @cached_property
    def no_match(self) -> DataFrame:
        return self._ledger("2-HIGH").select(*S.NO_MATCH_COLUMNS)

    @cached_property
    def review_ledger(self) -> DataFrame:
        return self._ledger("5-LOW").drop("match_found")

    @cached_property
    def sheets(self) -> DataFrame:
        """Completed review sheets: one row per submission under review whose order is closed."""
        return self.fixture("history").filter(
            (F.col("priority") == "5-LOW") & F.col("match_found")).select("submission_number", "CASE_ID")

    @cached_property
    def wrangled(self) -> stages.WrangleResult:
        # two columns of this ledger are read, once: no need to store it
        rostered = self._stored_records.filter(F.col("priority") == "1-URGENT").drop("priority")
        return stages.wrangle(self.stored, rostered, CONFIG, staged)

    @cached_property
    def matched(self) -> stages.MatchResult:
        return stages.match(self.stored_with_people, self.wrangled, CONFIG, staged)

    @cached_property
    def rematched(self) -> stages.MatchResult:
        return stages.rematch(
            self.ledgers["no_match_tbl"], self.ledgers["rostered_tbl"],
            self.stored_with_people, CONFIG, staged)

    @cached_property
    def reviews(self) -> stages.ReviewResult:
        return stages.review(
            self.review_ledger, self.rostered, self.sheets, self.pulled, CONFIG)

    @cached_property
    def ledgers(self) -> dict[str, DataFrame]:
        """The earlier run's ledgers as stored tables, which is what they are outside of tests:
        one write for all of them."""
        recorded = staged(self._stored_records, "recorded")

        def of(priority: str) -> DataFrame:
            return recorded.filter(F.col("priority") == priority).drop("priority")

        return {"rostered_tbl": of("1-URGENT").drop("match_found"),
                "no_match_tbl": of("2-HIGH").select(*S.NO_MATCH_COLUMNS),
                "fuzzy_matched_review_tbl": of("5-LOW").drop("match_found")}

    @cached_property
    def whole_run(self) -> run.RunResult:
        """A run as it happens: frames that several outputs read are written once, the submissions
        by ``stored_submissions``, which the ledgers are made of as well."""
        inputs = run.Inputs(
            self.stored_submissions, self.fixture("wizard"), self.fixture("investigation"), self.sheets,
            self.forms)
        return run.plan(inputs, self.ledgers.__getitem__, CONFIG, self._stage)

    @staticmethod
    def _stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
        return df if label == "raw" else staged(df, label, partition_by)

    @cached_property
    def all_link(self) -> linkage.LinkResult:
        """Every submission linked, without the QA and history filters."""
        src = keep_one(self.standardized.select(*S.FUZZY_INPUT_COLUMNS), ["submission_number"])
        return linkage.demographic_link(
            src, self.registry, carry=["internal_create_date", "PatientFirstName",
                                       "PatientLastName", "SubmitterPatientNumber"])
