"""Files people read, and the rows behind them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.operators.forms import form_updates_text
from casebind.operators.frames import dates_as_text, keep_one, union_diagonal

KEY = "submission_number"
ROSTER_DATES = ["DOB", "SPECIMEN_COLLECTION_DTTM", "SPECIMEN_RECEIVED_DTTM"]


def review_sheet(*buckets: DataFrame) -> DataFrame:
    """One row per submission to review, with the empty answer columns."""
    rows = union_diagonal(*[b.select(*S.REVIEW_COLUMNS) for b in buckets])
    return keep_one(rows, [KEY]).withColumns({
        "good_match": F.lit(False), "resolved": F.lit(False),
        "notes": F.lit(None).cast("string"),
    })


def roster_text(roster: DataFrame) -> DataFrame:
    return dates_as_text(roster, "MM/dd/yyyy", ROSTER_DATES)


def cumulative_roster(rostered: DataFrame) -> DataFrame:
    """One row per submission over everything ever rostered."""
    return keep_one(rostered.select(*S.CUMULATIVE_COLUMNS), [KEY])


def write_csv(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(folder)


@dataclass(frozen=True)
class OutputFolder:
    """Where a run's files go: below the day and the run, so no run replaces another's."""

    folder: str
    run_date: dt.date
    run_id: str

    def path(self, kind: str) -> str:
        return f"{self.folder}/{kind}/run_date={self.run_date}/run={self.run_id}"

    def review_sheet(self, sheet: DataFrame) -> None:
        write_csv(sheet, self.path("qa/review"))

    def review_archive(self, sheets: DataFrame) -> None:
        """Keep the consumed review rows."""
        write_csv(sheets, self.path("qa/completed_review_archive"))

    def roster(self, roster: DataFrame) -> None:
        write_csv(roster_text(roster), self.path("subtype_roster"))

    def cumulative_roster(self, roster: DataFrame) -> None:
        write_csv(roster, self.path("cumulative_subtype_roster"))

    def review_rejects(self, rejects: DataFrame) -> None:
        """Lines of review sheets that could not be read, as they came."""
        write_csv(rejects, self.path("qa/review_rejects"))

    def form_updates(self, updates: DataFrame) -> None:
        form_updates_text(updates).write.option("ignoreNullFields", False).json(
            self.path("form_updates"))
