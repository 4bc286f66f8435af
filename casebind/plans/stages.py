"""The stages of a run: pull, wrangle, match, rematch and review.

Each takes and returns bundles of lazy frames. ``stage`` decides what happens to a frame that
several outputs read: ``staged`` writes it to the shared folder, ``unstaged`` leaves it lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.operators import delta, linkage, mrn, quality, roster
from casebind.operators.delta import Compared
from casebind.operators.frames import keep_one, union_diagonal
from casebind.operators.history import not_yet_rostered
from casebind.operators.linkage import LinkResult
from casebind.operators.skew import HotKeys, hot_keys, lookup_join
from casebind.operators.standardize import standardize
from casebind.settings import EngineConfig
from casebind.sources import tables
from casebind.sources.staging import Told, staged_and_counted, unstaged

KEY = "submission_number"
Stage = Callable[..., DataFrame]


@dataclass(frozen=True)
class PullResult:
    submissions: DataFrame
    received: DataFrame
    registry: DataFrame  # every case with each of its labs
    cases: DataFrame     # one row per case: for what no lab column is needed
    people: DataFrame    # distinct demographics of the registry
    told: Told           # ``rows`` of the submissions
    told_of: DataFrame   # the frame these were counted of


@dataclass(frozen=True)
class WrangleResult:
    checked: DataFrame
    clean: DataFrame
    issues: DataFrame
    to_link: DataFrame
    unflagged: DataFrame  # of the submissions in ``to_link``, their clean rows
    hot: HotKeys


@dataclass(frozen=True)
class MatchResult:
    link: LinkResult
    linked: DataFrame
    id_matched: DataFrame
    triage: Told  # submissions by bucket
    first: Compared | None = None  # what was compared for the first time

    def bucket(self, name: str) -> DataFrame:
        return self.linked.filter(F.col("bucket") == name).drop("bucket")

    @property
    def matched(self) -> DataFrame:
        """Exact and MRN matches, as they are appended to the roster ledger."""
        return union_diagonal(self.bucket("exact"), self.id_matched)

    @property
    def combined_roster(self) -> DataFrame:
        return self.matched.distinct()


@dataclass(frozen=True)
class ReviewResult:
    sheets: DataFrame
    reviewed: DataFrame
    roster: DataFrame
    rejects: DataFrame | None = None  # lines of sheets that could not be read


def pull(submissions: DataFrame, wizard: DataFrame, investigation: DataFrame,
         config: EngineConfig, stage: Stage = unstaged) -> PullResult:
    """The sources, each read once when staged: later stages all see the same rows.

    Cases and labs are written as they are read and only then joined, so that a case of a source
    that changes meanwhile is in one state everywhere.
    """
    if config.cutoff is not None:
        submissions = tables.submissions_since(submissions, config.cutoff)
    if config.case_code is not None:
        wizard = tables.cases_by_code(wizard, config.case_code)
    raw, told = staged_and_counted(submissions, stage, "raw")
    receipt = tables.raw_receipt(raw, config.primary_key, config.run_date)
    cases, labs = stage(wizard, "cases"), stage(investigation, "labs")
    registry = stage(tables.ref_assemble(cases, labs), "registry")
    unnested = tables.receipt_unnest(receipt)
    return PullResult(
        submissions=unnested,
        received=(tables.receipt_as_variant if config.variant_receipts else tables.receipt_as_json)(receipt),
        registry=registry,
        cases=cases,
        people=stage(linkage.reference_people(registry), "people"),
        told=told,
        told_of=unnested,
    )


def wrangle(pulled: PullResult, rostered: DataFrame, config: EngineConfig,
            stage: Stage = unstaged) -> WrangleResult:
    """Checks and split. What a submission's other rows and the history say of it goes into one
    narrow table; wide rows meet it only where they are read, with the columns that are asked for.
    """
    # the raw texts have been read into codes: no later stage asks for them
    needed = dict.fromkeys([*S.FUZZY_INPUT_COLUMNS, *S.STANDARD_COLUMNS])
    standard = stage(standardize(pulled.submissions).select(*needed), "standardized")
    hot = hot_keys(standard, [KEY])
    if config.history_by_date:
        standard, rostered = stage(not_yet_rostered(
            standard, rostered, with_date=True), "not_rostered"), rostered.limit(0)
    facts = stage(quality.submission_facts(standard, rostered), "facts")
    strict = config.strict_dob_rule
    unflagged = quality.unflagged(standard, strict)
    # reduced to one row per submission before they meet the facts
    to_link = stage(quality.without_facts(quality.link_input(unflagged), facts, []), "to_link")
    return WrangleResult(
        checked=quality.add_flags(quality.with_facts(standard, facts, hot), strict),
        clean=quality.without_facts(unflagged, facts, hot),
        issues=quality.issues(standard, facts, hot, strict),
        to_link=to_link, unflagged=unflagged, hot=hot)


def require_submissions(pulled: PullResult) -> None:
    """The rows were counted as they were written, so no job is started for this, unless they
    were replaced since."""
    known = pulled.submissions is pulled.told_of
    if not pulled.told()["rows"] if known else pulled.submissions.isEmpty():
        raise ValueError("there are no submissions to match")


def match(pulled: PullResult, wrangled: WrangleResult, config: EngineConfig,
          stage: Stage = unstaged) -> MatchResult:
    require_submissions(pulled)
    link = linkage.demographic_link(
        wrangled.to_link, pulled.people, config.link,
        carry=["internal_create_date", *mrn.ID_FIELDS], stage=stage)
    rows, triage = staged_and_counted(link.rows, stage, "link", *linkage.bucket_metrics())
    link = LinkResult(rows)
    scores = LinkResult(link.rows.drop(*mrn.ID_FIELDS))
    linked = stage(
        linkage.attach_original(scores, wrangled.unflagged, wrangled.hot, S.STANDARD_COLUMNS),
        "linked", ["bucket"])
    pairs = mrn.mrn_link(mrn.mrn_candidates(link), pulled.cases)
    by_id = mrn.id_matched_full(
        pairs, linked.filter(F.col("bucket").isin("unmatched", "no_demo")),
        config.run_date, wrangled.hot)
    return MatchResult(link, linked, stage(by_id, "id_matched"), triage)


def rematch(no_match: DataFrame, rostered: DataFrame, pulled: PullResult, config: EngineConfig,
            stage: Stage = unstaged, seen: Compared | None = None) -> MatchResult:
    """Try the open non-matches of earlier runs, but those rostered since, against today's
    registry.

    With ``seen``, what was compared before without a match is not compared again: known
    non-matches meet only the registry rows that are new or changed.
    """
    history = tables.open_non_matches(no_match)
    hot = hot_keys(history, [KEY])
    # reduced to one row per submission before they meet the rostered ones; wide rows meet only the
    # links, of which there are none for what is rostered
    people = stage(not_yet_rostered(keep_one(
        history.select(KEY, "internal_create_date", *linkage.PERSON), [KEY]), rostered, []), "rematch_input")
    persons = linkage.people(people, linkage.LEDGER, ["internal_create_date"])
    hot_people = hot_keys(people, linkage.PERSON)
    if seen is None:
        found = linkage.link_persons(persons, pulled.people, config.link, stage)
    else:
        found, new_persons, new_people = delta.delta_links(persons, pulled.people, seen, config.link, stage)
    rows, triage = staged_and_counted(
        linkage.with_links(persons, found, ["internal_create_date"], hot_people).rows, stage,
        "rematch_link", *linkage.bucket_metrics())
    link = LinkResult(rows)
    linked = stage(
        linkage.attach_original(link, history, hot, S.STANDARD_COLUMNS), "rematch_linked", ["bucket"])
    ids = mrn.possible_numbers(mrn.mrn_recover(
        link.bucket("unmatched", "no_demo"), pulled.submissions, config.primary_key))
    if seen is None:
        pairs, first = mrn.number_pairs(ids, pulled.cases), None
    else:
        pairs, new_ids, new_numbers = delta.delta_number_links(
            stage(ids, "rematch_ids"), pulled.cases, seen, stage)
        first = Compared(new_persons, new_people, new_numbers, new_ids)
    by_id = mrn.id_matched_full(
        pairs, linked.filter(F.col("bucket").isin("unmatched", "no_demo")), config.run_date, hot)
    return MatchResult(link, linked, stage(by_id, "rematch_id_matched"), triage, first)


def review_merge(review_ledger: DataFrame, sheets: DataFrame) -> DataFrame:
    """Review ledger rows whose submission came back reviewed, on however many sheets."""
    return lookup_join(review_ledger, sheets.select(KEY).distinct(), [KEY], "inner").select(
        *review_ledger.columns)


def review(review_ledger: DataFrame, rostered: DataFrame, sheets: DataFrame,
           pulled: PullResult, config: EngineConfig) -> ReviewResult:
    """A sheet that stays where it was read from is rostered once only."""
    reviewed = review_merge(not_yet_rostered(review_ledger, rostered), sheets)
    rows = roster.create_roster(reviewed, pulled.cases, config.run_date)
    return ReviewResult(sheets, reviewed, roster.not_in_registry(rows, pulled.registry))


def final_roster(main: MatchResult, again: MatchResult, reviews: ReviewResult,
                 pulled: PullResult, config: EngineConfig) -> DataFrame:
    return roster.union_rosters(
        main.matched, again.matched, reviews.roster, pulled.registry, config.run_date, pulled.cases)
