"""Time the headline queries and print one JSON line.

The inputs (submissions, registry, ledgers) are derived from the test tables and stored first,
as a deployment would find them; that step is not timed. ``BENCH_SF_DIR`` and ``BENCH_CPUS``
choose the data and the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from casebind.operators import forms, linkage, mrn, quality, roster
from casebind.operators.standardize import standardize
from casebind.plans import run, stages
from casebind.sources.ledger import Ledger
from casebind.sources.staging import staged, staging_path
from casebind.sources.tables import ref_assemble
from checks.compare import session
from checks.inputs import CONFIG, Inputs


def consume(df: DataFrame) -> None:
    """Compute every row and column without collecting them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cores)
    i = Inputs(spark, sf_dir)
    ledgers = i.ledgers
    # several files, so that the scan itself is spread as it is on real tables
    submissions = staged(i.submissions.repartition(cores), "submissions")
    wizard, labs = (staged(i.fixture(n), n) for n in ("wizard", "investigation"))
    sheets, form_table = staged(i.sheets, "sheets"), staged(i.forms, "forms")
    # what a run writes before it matches
    pulled = stages.pull(submissions, wizard, labs, CONFIG, staged)
    registry, cases, known = pulled.registry, pulled.cases, pulled.people
    standardized = standardize(pulled.submissions)
    to_link = staged(quality.link_input(standardized), "to_link")
    carry = ["internal_create_date", *mrn.ID_FIELDS]

    def link() -> linkage.LinkResult:
        return linkage.demographic_link(to_link, known, CONFIG.link, carry=carry, stage=staged)

    def planned() -> run.RunResult:
        inputs = run.Inputs(submissions, wizard, labs, sheets, form_table)
        return run.plan(inputs, ledgers.__getitem__, CONFIG, staged)

    def written_run() -> DataFrame:
        """Match everything and write every ledger and file, to new folders."""
        result, ledger = planned(), Ledger(spark, staging_path(spark, "bench-ledger"))
        run.combine_and_write(result, ledger, staging_path(spark, "bench-out"), form_table, CONFIG)
        return result.roster

    queries = {
        "standardize": lambda: standardized,
        "wrangle": lambda: stages.wrangle(pulled, ledgers["rostered_tbl"], CONFIG).checked,
        "qa_multiple_subtypes": lambda: quality.multiple_subtypes(standardized),
        "demographic_link": lambda: link().rows,
        "mrn_link": lambda: mrn.mrn_link(to_link, cases),
        "rematch": lambda: stages.rematch(
            ledgers["no_match_tbl"], ledgers["rostered_tbl"], pulled, CONFIG, staged).matched,
        "create_roster": lambda: roster.dedup_roster(
            roster.create_roster(ledgers["fuzzy_matched_review_tbl"], cases, CONFIG.run_date), registry),
        "form_updates": lambda: forms.form_updates(
            roster.create_roster(ledgers["fuzzy_matched_review_tbl"], cases, CONFIG.run_date),
            form_table, cases),
        "ref_assemble": lambda: ref_assemble(wizard, labs),
        "run": lambda: planned().roster,
        "run_written": written_run,
    }
    seconds = {}
    for name, build in queries.items():
        best = None
        for _ in range(2):
            start = time.perf_counter()
            consume(build())
            taken = time.perf_counter() - start
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf_dir.rstrip("/").rsplit("sf", 1)[-1]), "cpus": cores,
        "rows": {"analytes": submissions.count(), "submissions": to_link.count(),
                 "registry": registry.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
