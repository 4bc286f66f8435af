"""Retrying against what is new only.

A pair of rows that an earlier run compared without a match gives none today. So of today's
pairs (persons x registry) only (known persons x new registry rows) and (new persons x all
registry rows) can match: the semi-naive step of a growing join. What was compared is kept in
append-only tables; a row that is not there, for whatever reason, is compared with everything.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.operators import mrn
from casebind.operators.linkage import PERSON, complete, link_persons
from casebind.settings import LinkConfig
from casebind.sources.staging import unstaged

Stage = Callable[..., DataFrame]
REFERENCE = ["first_name_clean_right", "last_name_clean_right", "ref_dob",
             "reference_collection_date", "CASE_ID", "last_case_id"]
NUMBER, CANDIDATE = ["CASE_ID", "MRN"], [mrn.KEY, "MRN"]


@dataclass(frozen=True)
class Compared:
    """What has been compared: submitted demographics and registry people under one link rule,
    record numbers of cases, and record numbers of submissions."""

    persons: DataFrame
    people: DataFrame
    numbers: DataFrame
    candidates: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f"compared_{f.name}": getattr(self, f.name) for f in fields(self)}


def link_rule(link: LinkConfig) -> str:
    """What a comparison depends on besides its rows; rows compared under another rule do not count."""
    return f"{link.threshold}/{link.day_window}/{int(link.birth_date_slips)}"


def unseen(rows: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct ``rows`` that ``seen`` lacks. Without nulls, as both come from what was compared."""
    return rows.select(*on).distinct().join(seen.select(*on), list(on), "left_anti")


def delta_links(persons: DataFrame, people: DataFrame, compared: Compared, link: LinkConfig,
                stage: Stage = unstaged) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``link_persons(persons, people)`` for persons that no earlier comparison matched, then the
    persons and the people that are compared for the first time."""
    persons = persons.filter(complete()).select(*PERSON).distinct()
    fresh = stage(unseen(people, compared.people, REFERENCE), "fresh_people")
    first = stage(unseen(persons, compared.persons, PERSON), "first_persons")
    known = persons.join(first, PERSON, "left_anti")
    linked = link_persons(known, fresh, link, stage)
    if not first.isEmpty():
        linked = linked.unionByName(link_persons(first, people, link, stage))
    return linked, first, fresh


def delta_number_links(ids: DataFrame, cases: DataFrame, compared: Compared,
                       stage: Stage = unstaged) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``mrn_link`` of the possible record numbers ``ids`` of submissions that none has linked yet,
    the ids tried for the first time, and the case numbers that are new."""
    numbers = mrn.case_mrns(cases)
    fresh = stage(unseen(numbers, compared.numbers, NUMBER), "fresh_numbers")
    first = stage(unseen(ids, compared.candidates, CANDIDATE), "first_candidates")
    pairs = ids.join(first, CANDIDATE, "left_anti").join(fresh, "MRN").select(mrn.KEY, "CASE_ID")
    if not first.isEmpty():
        pairs = pairs.union(first.join(numbers, "MRN").select(mrn.KEY, "CASE_ID"))
    return pairs.distinct(), first, fresh
