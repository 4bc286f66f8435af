"""One whole run: read, match, write."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.operators import forms as form_ops
from casebind.operators import linkage, mrn
from casebind.operators.delta import CANDIDATE, Compared, link_rule, unseen
from casebind.operators.frames import union_diagonal
from casebind.plans import stages
from casebind.plans.stages import KEY, MatchResult, PullResult, ReviewResult, WrangleResult
from casebind.settings import EngineConfig
from casebind.sinks import ledgers, outputs
from casebind.sources import tables
from casebind.sources.ledger import Ledger
from casebind.sources.staging import staged


@dataclass(frozen=True)
class Inputs:
    """The sources. Review sheets may be a glob of CSV files, forms a path of JSON lines, as
    people and the form registry leave them; ``form_schema`` then has the columns of the forms."""

    submissions: DataFrame
    wizard: DataFrame
    investigation: DataFrame
    review_sheets: DataFrame | str
    forms: DataFrame | str
    form_schema: str | None = None

    def read_sheets(self) -> tuple[DataFrame, DataFrame | None]:
        """(rows, lines that are none)"""
        if isinstance(self.review_sheets, str):
            return tables.review_sheets(self.submissions.sparkSession, self.review_sheets)
        return self.review_sheets, None

    def read_forms(self) -> DataFrame:
        if isinstance(self.forms, str):
            return tables.form_records(self.submissions.sparkSession, self.forms, self.form_schema)
        return self.forms


@dataclass(frozen=True)
class RunResult:
    pulled: PullResult
    wrangled: WrangleResult
    main: MatchResult
    again: MatchResult
    reviews: ReviewResult
    roster: DataFrame
    seen: Compared | None = None  # what earlier runs compared, if retries made use of it
    report: dict | None = None  # what was counted on the way, once written
    run_id: str = field(default_factory=lambda: f"{dt.datetime.now():%H%M%S}-{uuid.uuid4().hex[:8]}")

    def open_non_matches(self) -> DataFrame:
        """What no demographics and no record number linked, to be tried again."""
        linked = self.main.id_matched.select(KEY).distinct()
        return self.main.bucket("unmatched").join(linked, KEY, "left_anti").withColumn(
            "match_found", F.lit(False))

    def buckets(self) -> dict[str, DataFrame]:
        """The frames that go to ledger tables."""
        return {
            "qa_issues": self.wrangled.issues,
            "received": self.pulled.received,
            "unmatched": self.open_non_matches(),
            "fuzzy": self.main.bucket("fuzzy"),
            "exact": self.main.bucket("exact"),
            "id_matched": self.main.id_matched,
            "combined_roster": self.main.matched,
            "reviewed": self.reviews.reviewed,
            "no_demo": self.main.bucket("no_demo"),
            "roster": self.roster,
        }

    def review_sheet(self) -> DataFrame:
        return outputs.review_sheet(self.main.bucket("fuzzy"), self.again.bucket("fuzzy"))

    def newly_compared(self, config: EngineConfig) -> dict[str, DataFrame]:
        """What this run compared first: registry rows and retried submissions as the retry told
        them, and the submissions of today that stay open."""
        if self.seen is None:
            return {}
        rule, new, link = F.lit(link_rule(config.link)).alias("rule"), self.again.first, self.main.link
        numbers = mrn.possible_numbers(mrn.mrn_candidates(link))
        today = link.unmatched.select(*linkage.PERSON)
        return Compared(
            persons=unseen(union_diagonal(new.persons, today), self.seen.persons, linkage.PERSON).select(rule, "*"),
            people=new.people.select(rule, "*"), numbers=new.numbers,
            candidates=unseen(union_diagonal(new.candidates, numbers), self.seen.candidates, CANDIDATE)).tables()

    def resolved_keys(self) -> DataFrame:
        """Old non-matches that have a case or a review row now."""
        return union_diagonal(
            self.again.bucket("fuzzy").select(KEY), self.again.matched.select(KEY))


def combine_and_write(result: RunResult, ledger: Ledger, folder: str, forms: DataFrame,
                      config: EngineConfig) -> dict:
    """Write a run's files, each below its day and run, then its ledgers.

    Returns the report of the run: submissions by bucket, and rows appended by bucket and table,
    all counted by the jobs that wrote them.
    """
    hot, at, sheet = result.wrangled.hot, config.deployment, result.review_sheet()
    to = outputs.OutputFolder(folder, config.run_date, result.run_id)
    to.review_sheet(sheet)
    appended = {("review_sheet", at.sheets): ledger.insert_if_absent(at.sheets, sheet, KEY, hot)}
    to.review_archive(result.reviews.sheets)
    if result.reviews.rejects is not None:
        to.review_rejects(result.reviews.rejects)
    to.roster(result.roster)
    to.form_updates(form_ops.form_updates(result.roster, forms, result.pulled.cases))
    appended |= ledgers.route_outputs(ledger, result.buckets(), at.routes, hot)
    if at.roster:
        appended["roster", at.roster] = ledger.insert_if_absent(at.roster, result.roster, S.ROSTER_KEY)
    rewritten = ledgers.write_rematch(
        ledger, result.again.bucket("fuzzy"), result.again.matched if at.rematched == at.rostered
        else result.again.bucket("exact"), result.resolved_keys(), at, hot)
    for table, rows in result.newly_compared(config).items():  # what is not told is compared again
        appended["compared", table] = ledger.append(table, rows)
    to.cumulative_roster(ledgers.cumulative(ledger, at.rostered))
    return {"analytes": result.pulled.told()["rows"], "match": result.main.triage(),
            "rematch": result.again.triage(), "appended": appended, "ledger_buckets_rewritten": rewritten}


def compared(ledger: Ledger, config: EngineConfig) -> Compared:
    """What earlier runs compared under today's link rule."""
    rule = F.col("rule") == link_rule(config.link)
    return Compared(
        persons=ledger.read("compared_persons").filter(rule),
        people=ledger.read("compared_people").filter(rule),
        numbers=ledger.read("compared_numbers"), candidates=ledger.read("compared_candidates"))


def plan(inputs: Inputs, ledger_tables, config: EngineConfig, stage=staged,
         seen: Compared | None = None) -> RunResult:
    """Everything up to the writes; ``ledger_tables`` gives a ledger frame by name.

    With ``seen``, old non-matches are retried against what is new only.
    """
    pulled = stages.pull(inputs.submissions, inputs.wizard, inputs.investigation, config, stage)
    rostered = ledger_tables(config.deployment.rostered)
    wrangled = stages.wrangle(pulled, rostered, config, stage)
    main = stages.match(pulled, wrangled, config, stage)
    again = stages.rematch(
        ledger_tables(config.deployment.no_match), rostered, pulled, config, stage, seen)
    sheets, rejects = inputs.read_sheets()
    reviews = dataclasses.replace(stages.review(
        ledger_tables(config.deployment.reviews), rostered, sheets, pulled, config), rejects=rejects)
    final = stage(stages.final_roster(main, again, reviews, pulled, config), "roster")
    return RunResult(pulled, wrangled, main, again, reviews, final, seen)


def run(inputs: Inputs, ledger: Ledger, folder: str, config: EngineConfig,
        write_data: bool = False) -> RunResult:
    """Match everything; write only when asked to."""
    result = plan(inputs, ledger.read, config, seen=compared(ledger, config))
    if write_data:
        report = combine_and_write(result, ledger, folder, inputs.read_forms(), config)
        return dataclasses.replace(result, report=report)
    return result
