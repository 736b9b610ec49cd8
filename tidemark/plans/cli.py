"""python -m tidemark.plans.cli MODE --store FOLDER --request ID ...: one run; the exit code tells its outcome."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import collect, windows
from ..schema import PAGE_CAP
from ..sources.crawl import items, numbered_files, page_log
from ..sources.generator import synthetic_rows
from . import evidence, summaries
from .jobs import EXIT, Request, Run, run
from .store import Store, settled


def day_windows(spark: SparkSession, since: str, until: str) -> list[tuple[str, str]]:
    """The UTC days of a half-open range of instants, the first and the last cut to it."""
    at = lambda x: F.lit(x).cast("timestamp").cast("timestamp_ntz")
    plan = windows.day_plan(spark.range(1).select(at(since).alias("range_from"), at(until).alias("range_until"))).orderBy("window_sequence")
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return [tuple(r) for r in plan.select(text("window_from"), text("window_until")).collect()]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("mode", choices=["BACKFILL", "INCREMENTAL", "REPLAY_ERRORS", "BENCHMARK", "PREFLIGHT", "SUMMARY"])
    p.add_argument("--store", required=True)
    p.add_argument("--request", required=True, help="the run's own; for PREFLIGHT the mode that is to be run")
    p.add_argument("--pages", help="folder of page files, in the order of the numbers in their names")
    p.add_argument("--url", help="paged source to ask in place of page files, a window for each day of the range")
    p.add_argument("--folder", help="paged source as a folder for each window, in place of --url")
    p.add_argument("--since", help="start of the range, an ISO instant; must be the mark where there is one")
    p.add_argument("--bootstrap", help="start of the first incremental range, where there is no mark yet")
    p.add_argument("--page-cap", type=int, default=PAGE_CAP, help="most pages of a window")
    p.add_argument("--limit", type=int, help="most rows of the run, over all windows")
    p.add_argument("--source", default="default")
    p.add_argument("--until", help="end of an incremental range, an ISO instant")
    p.add_argument("--source-execution")
    p.add_argument("--rows", type=int, default=100_000)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--chunk-size", type=int, default=1000)
    p.add_argument("--outcome", help="file for the outcome")
    p.add_argument("--report", help="folder for a run's summary as JSON, HTML and properties")
    p.add_argument("--scenario", choices=evidence.SCENARIOS, help="what a benchmark run is held against")
    p.add_argument("--evidence", help="folder of benchmark figures; a run of a million rows needs both scenarios of 100,000 there")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.mode == "PREFLIGHT":
        print(json.dumps(summaries.preflight(Store(spark, a.store), a.request)))
        return 0
    if a.mode == "SUMMARY":
        found = summaries.summary(Store(spark, a.store), a.request)
        if a.report:
            summaries.write_summary(a.report, found, spark)
        print(json.dumps(found))
        return 1 if found["faults"] else 0
    if a.evidence and a.mode == "BENCHMARK" and (wrong := evidence.million_gate(a.rows, evidence.read(a.evidence), a.seed)):
        p.error("; ".join(wrong))
    origin = {"pages": a.pages, "url": a.url, "folder": a.folder, "since": a.since, "until": a.until, "limit": a.limit}
    identity = {"BACKFILL": origin, "INCREMENTAL": {**origin, "source": a.source, "bootstrap": a.bootstrap}, "REPLAY_ERRORS": {"source_execution": a.source_execution}, "BENCHMARK": {"rows": a.rows, "seed": a.seed}}[a.mode]
    request, more, store = Request(a.request, a.mode, identity), {}, Store(spark, a.store)
    if a.mode == "BENCHMARK":
        more["rows"] = synthetic_rows(spark, a.rows, a.seed)
    elif a.mode != "REPLAY_ERRORS" and a.pages:
        paged, order = settled(numbered_files(spark, a.pages)), ["window_id", "page_no", "position"]
        found = items(paged)
        more["collected"] = (collect.limited(found, order, a.limit, settled).drop("execution_sequence") if a.limit else found), order
        more["pages"] = page_log(paged)
    elif a.mode != "REPLAY_ERRORS":
        job = Run(store, request, a.chunk_size)
        if job.begin() == "ALREADY_COMPLETED":
            return EXIT["ALREADY_COMPLETED"]
        since, until = job.state().get("since") or a.since, job.state().get("until") or a.until
        if not since or not until:
            p.error("a range needs --since and --until where no mark and no start of a run stand in")
        # a backfill asks for what was created in one range, an incremental run for what was indexed day by day
        ranges, field = ([(since, until)], "created-date") if a.mode == "BACKFILL" else (day_windows(spark, since, until), "index-date")
        more["plan"] = {"plan": ranges, "limit": a.limit, "cap": a.page_cap, "field": field, **({"url": a.url} if a.url else {"folder": a.folder})}
    code = run(store, request, chunk_size=a.chunk_size, **more)
    if a.evidence and a.scenario and a.mode == "BENCHMARK" and code != EXIT["ALREADY_COMPLETED"]:
        figures = summaries.benchmark_evidence(store, request.execution_id, a.scenario, a.rows, a.seed)
        evidence.write(a.evidence, figures)
        code = code or int(bool(figures["contradictions"]))
    if a.report:
        summaries.write_summary(a.report, summaries.summary(store, a.request), spark)
    if a.outcome:
        evidence.outcome_file(a.outcome, code, "sync", request.request_id, request.mode, request.execution_id)
    return code


if __name__ == "__main__":
    sys.exit(main())
