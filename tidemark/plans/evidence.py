"""Evidence of benchmark runs: figures, gates, and a report written as JSON and Markdown."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

SCENARIOS = ("initial", "no-op")
FIELDS = ("scenario", "rows", "preload_ms", "sync_ms", "verify_ms", "status")


def semantics(scenario: str, rows: int, totals: dict[str, int], status: str) -> list[str]:
    """What contradicts the scenario: an initial run inserts every row, a no-op run changes none."""
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown scenario: {scenario}")
    wanted = "inserted_count" if scenario == "initial" else "no_op_count"
    wrong = [f"{k} is {v}" for k, v in totals.items() if k.endswith("_count") and v != (rows if k == wanted else 0)]
    return wrong + ([] if status == "COMPLETED" else [f"status is {status}"])


def million_gate(rows: int, earlier: list[dict], seed: int) -> list[str]:
    """A run of a million rows or more needs both scenarios at 100,000 rows with the same seed, completed."""
    if rows < 1_000_000:
        return []
    return [f"no completed {s} run of 100000 rows" for s in SCENARIOS if not any(e.get("scenario") == s and e.get("rows") == 100_000 and e.get("seed") == seed and e.get("status") == "COMPLETED" for e in earlier)]


def read(folder: str) -> list[dict]:
    return [json.loads(p.read_text()) for p in sorted(Path(folder).glob("*.json"))]


def _replace(path: Path, text: str) -> None:
    with tempfile.NamedTemporaryFile("w", dir=path.parent, delete=False) as part:
        part.write(text)
    os.replace(part.name, path)


def write(folder: str, figures: dict) -> Path:
    """<scenario>-<rows>.json and .md, each replaced as a whole."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    base = Path(folder, f"{figures['scenario']}-{figures['rows']}")
    _replace(base.with_suffix(".json"), json.dumps(figures, indent=2, sort_keys=True))
    _replace(base.with_suffix(".md"), "".join(["| figure | value |\n|---|---|\n", *(f"| {k} | {figures[k]} |\n" for k in sorted(figures))]))
    return base.with_suffix(".json")


def outcome_file(path: str, code: int, job: str, request_id: str, mode: str, execution_id: str) -> None:
    """name=value lines about a finished process; values can't break a line."""
    safe = lambda v: "".join("_" if c in "\r\n=" else c for c in str(v))
    lines = {"code": code, "outcome": {0: "COMPLETED", 1: "FAILED", 2: "COMPLETED_WITH_ERRORS", 3: "ALREADY_COMPLETED"}[code], "job": job, "requestId": request_id, "mode": mode, "executionId": execution_id}
    _replace(Path(path), "".join(f"{k}={safe(v)}\n" for k, v in lines.items()))


def read_properties(path: str) -> dict[str, str]:
    return dict(line.split("=", 1) for line in Path(path).read_text().splitlines() if "=" in line)
