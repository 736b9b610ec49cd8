"""What a store says about its runs: a preflight that is checked again, one run's summary, and evidence of a benchmark.

A run's own facts are a row of a small table, one for each run; all counting is left to Spark over the store's tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import duration_text, html_escape
from ..operators import reports, tree_digest, verify
from . import evidence
from .store import Store

#: What a summary holds, neither more nor less, in this order.
SUMMARY = (
    "schema_version", "request_id", "mode", "status", "reason", "execution_id", "source_execution_id", "selected_error_bound", "selected_error_count", "source_open_errors", "source_resolved_errors",
    "open_errors", "replayable_errors", "error_groups", "next_mode", "expected_count", "staged_count", "accounted_count", "pages_fetched", "stopped", "collect_ms", "sync_ms", "verify_ms", "faults",
)
EXECUTIONS = "execution_id string, request_id string, mode string, status string, expected_count bigint, pages bigint, started_at string, finished_at string"


def exact(names: Iterable[str], wanted: Iterable[str]) -> None:
    """An error unless these are the wanted names, each of them once, in any order."""
    have, want = list(names), set(wanted)
    if len(have) != len(set(have)) or set(have) != want:
        raise ValueError(f"columns missing: {sorted(want - set(have))}, not wanted: {sorted(set(have) - want)}, twice: {sorted({x for x in have if have.count(x) > 1})}")


def runs(at: dict) -> dict[str, dict]:
    """The facts of each run, by execution."""
    return {k[4:]: v for k, v in at["facts"].items() if k.startswith("run:")}


def executions(store: Store, at: dict) -> DataFrame:
    rows = [(k, f["request"]["request_id"], f["request"]["mode"], f.get("status"), f.get("expected"), (f.get("collected") or {}).get("pages", 0), f.get("started"), f.get("finished")) for k, f in runs(at).items()]
    return store.spark.createDataFrame(rows, EXECUTIONS)


def _tables(store: Store, at: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    return store.read("errors", schema.ERRORS, at), store.read("staging", schema.STAGING, at), store.read("chunks", schema.CHUNKS, at)


def preflight(store: Store, mode: str) -> dict:
    """What a run of that mode may do, on which errors, and the version that this was seen in."""
    at = store.manifest()
    errors, staging, _ = _tables(store, at)
    return {**reports.preflight_report(errors, staging, executions(store, at), mode).first().asDict(), "mode": mode, "version": at["version"]}


def recheck(store: Store, seen: dict) -> dict:
    """The preflight anew; an error if its decision, source or selected errors have changed since it was seen.

    Where no commit has come between, or none that changes errors, staging or runs' ends, nothing is read.
    """
    old, now = store.manifest(seen["version"]) if seen["version"] in (0, *store.versions()) else None, store.manifest()
    ends = lambda at: {k: f.get("status") for k, f in runs(at).items()}
    if old is not None and ends(old) == ends(now) and all(old["tables"].get(t) == now["tables"].get(t) for t in ("errors", "staging")):
        return {**seen, "version": now["version"]}
    again = preflight(store, seen["mode"])
    if changed := [k for k in seen if k != "version" and seen[k] != again[k]]:
        raise ValueError(f"the source has changed since the preflight: {', '.join(changed)}")
    return again


def _ms(times: list[str] | None) -> int | None:
    return None if not times else round((datetime.fromisoformat(times[1]) - datetime.fromisoformat(times[0])).total_seconds() * 1000)


def summary(store: Store, request_id: str, expected: int | None = None, pages: int | None = None) -> dict:
    """One run's summary, with what contradicts it: rows and pages that a backfill should have had, a replay's source."""
    at = store.manifest()
    found = {k: f for k, f in runs(at).items() if f["request"]["request_id"] == request_id}
    if not found:
        raise ValueError(f"no run of request {request_id}")
    own, facts = max(found.items(), key=lambda x: x[1]["started"])
    mode, source = facts["request"]["mode"], facts["request"]["identity"].get("source_execution")
    errors, staging, chunks = _tables(store, at)
    mine = lambda name, shape: store.read(name, shape, at, own).where(f"execution_id = '{own}'")
    row = reports.run_summary(executions(store, at).where(f"execution_id = '{own}'"), mine("staging", schema.STAGING), mine("chunks", schema.CHUNKS), mine("errors", schema.ERRORS))
    bound = facts.get("error_bound", 0)
    if source:
        left = reports.remaining(errors.where(F.col("execution_id") == source), bound).first() or {"open_count": 0, "resolved_count": 0}
        row = row.selectExpr("*", f"{left['open_count']} source_open", f"{left['resolved_count']} source_resolved", f"{facts.get('selected', 0)} selected")
    faults = reports.summary_faults(row, facts.get("expected", 0) if expected is None else expected, (facts.get("collected") or {}).get("pages", 0) if pages is None else pages).first()["faults"]
    got, ahead = row.first().asDict(), preflight(store, "BACKFILL")
    grouped = reports.error_groups(errors.where("status = 'OPEN'").withColumn("all", F.lit(1)), ["VALIDATION", "CONFLICT"], [schema.CONFLICT_CODE], "all").first()
    groups = json.loads(grouped["groups_json"]) if grouped else []
    steps = facts.get("steps", {})
    out = {
        "schema_version": 1, "request_id": request_id, "mode": mode, "status": facts.get("status"), "reason": (facts.get("verdict") or {}).get("reason"), "execution_id": own, "source_execution_id": source,
        "selected_error_bound": bound, "selected_error_count": facts.get("selected", 0), "source_open_errors": got.get("source_open", 0), "source_resolved_errors": got.get("source_resolved", 0),
        "open_errors": ahead["open_errors"], "replayable_errors": ahead["replayable_errors"], "error_groups": groups, "next_mode": ahead["next_mode"],
        "expected_count": facts.get("expected", 0), "staged_count": got["staged"], "accounted_count": got["accounted"], "pages_fetched": got["pages"] or 0, "stopped": facts.get("stopped"),
        **{f"{x}_ms": _ms(steps.get(x)) for x in ("collect", "sync", "verify")}, "faults": faults,
    }
    exact(out, SUMMARY)
    return out


def write_summary(folder: str, figures: dict, spark) -> list[Path]:
    """<request>.json, .html and .properties in a folder, each replaced as a whole."""
    exact(figures, SUMMARY)
    base = Path(folder, f"run-{figures['request_id']}")
    base.parent.mkdir(parents=True, exist_ok=True)
    times = {k: v for k, v in figures.items() if k.endswith("_ms")}
    cells = {k: json.dumps(v) if isinstance(v, list | dict) else "-" if v is None else str(v) for k, v in figures.items()}
    shown = spark.createDataFrame([(k, cells[k], times.get(k), k in times) for k in SUMMARY], "k string, v string, ms bigint, timed boolean")
    shown = shown.selectExpr("k", "v", "ms", "timed").withColumn("v", html_escape(shown["v"])).withColumn("t", duration_text(shown["ms"])).collect()
    lines = "".join(f'<tr><th scope="row">{r["k"]}</th><td>{r["t"] if r["timed"] else r["v"]}</td></tr>\n' for r in shown)
    page = f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>Run {base.name[4:]}</title></head><body><table>\n{lines}</table></body></html>\n'
    safe = lambda v: "".join("_" if c in "\r\n=" else c for c in v)
    out = []
    for suffix, text in (("json", json.dumps(figures, indent=2)), ("html", page), ("properties", "".join(f"{k}={safe(cells[k])}\n" for k in SUMMARY))):
        evidence._replace(path := base.parent / f"{base.name}.{suffix}", text)
        out.append(path)
    return out


def benchmark_evidence(store: Store, execution_id: str, scenario: str, rows: int, seed: int) -> dict:
    """Figures of a benchmark run, the digests of what it staged and of the target, and what contradicts its scenario."""
    at = store.manifest()
    facts = runs(at)[execution_id]
    own = store.read("staging", schema.STAGING, at, execution_id).where(f"execution_id = '{execution_id}'")
    totals = verify.outcome_totals(store.read("chunks", schema.CHUNKS, at, execution_id).where(f"execution_id = '{execution_id}'")).first().asDict()
    root = lambda df: (df.orderBy("level", ascending=False).first() or {"digest": None})["digest"]
    target = store.read("target", schema.TARGET, at).select("doi", "content_hash").withColumnRenamed("content_hash", "target_hash")
    joined = own.select("execution_sequence", "doi", "content_hash").join(target, "doi", "left")
    steps = facts.get("steps", {})
    return {
        "scenario": scenario, "rows": rows, "seed": seed, "status": facts["status"], "execution_id": execution_id, **totals, **{f"{k}_ms": _ms(steps.get(x)) for k, x in (("preload", "collect"), ("sync", "sync"), ("verify", "verify"))},
        "staging_digest": root(tree_digest.tree(own, "execution_sequence", ["doi", "content_hash"])), "target_digest": root(tree_digest.tree(joined, "execution_sequence", ["doi", "target_hash"])),
        "contradictions": evidence.semantics(scenario, rows, totals, facts["status"]),
    }
