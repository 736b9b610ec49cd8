"""Summaries, preflights and benchmark evidence that are read from a store."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.plans import cli, evidence, jobs, summaries
from tidemark.plans.store import Store
from tidemark.sources.generator import synthetic_rows


def items(spark, *records):
    rows = [(k, json.dumps({"DOI": d, "title": [t], "indexed": {"date-time": f"2026-08-08T00:00:0{s}Z"}})) for k, (d, t, s) in enumerate(records)]
    return spark.createDataFrame(rows, "n bigint, json string").select("n", F.from_json("json", schema.ITEM).alias("item")), ["n"]


def with_validation_errors(store, spark, request, n):
    """A backfill that ended with n open validation errors, as a source that is validated elsewhere leaves it."""
    assert jobs.run(store, request, items(spark, *[(f"10.2/{k}", "t", 1) for k in range(4)])) == 0
    at = store.manifest()
    keys = [r.staging_key for r in store.read("staging", at=at).orderBy("staging_key").limit(n).collect()]
    found = spark.createDataFrame([(k + 1, request.execution_id, key, "VALIDATION", "E9", None, "OPEN", 0, None, None) for k, key in enumerate(keys)], schema.ERRORS)
    fact = {f"run:{request.execution_id}": {**at["facts"][f"run:{request.execution_id}"], "status": "COMPLETED_WITH_ERRORS"}}
    store.commit({"errors": found}, {**fact, "top_error": n})


def test_summary_and_preflight_of_a_store(spark, tmp_path, capsys):
    store, source = Store(spark, f"{tmp_path}/s"), jobs.Request("first", "BACKFILL")
    with_validation_errors(store, spark, source, 2)
    seen = summaries.preflight(store, "BACKFILL")
    assert (seen["decision"], seen["next_mode"], seen["selected"], seen["error_bound"], seen["source_execution_id"]) == ("OPEN_ERRORS_REQUIRE_REPLAY", "REPLAY_ERRORS", 2, 2, source.execution_id)
    store.commit(facts={"unlike": 1})
    assert summaries.recheck(store, seen) == {**seen, "version": store.manifest()["version"]}
    got = summaries.summary(store, "first")
    assert list(got) == list(summaries.SUMMARY)
    assert (got["expected_count"], got["staged_count"], got["accounted_count"], got["open_errors"], got["next_mode"]) == (4, 4, 4, 2, "REPLAY_ERRORS")
    assert got["error_groups"] == [{"type": "VALIDATION", "code": "OTHER", "count": 2}] and set(got["faults"]) == {"status", "open errors"}
    assert all(got[f"{x}_ms"] > 0 for x in ("collect", "sync", "verify"))
    assert cli.main(["SUMMARY", "--store", f"{tmp_path}/s", "--request", "first", "--report", f"{tmp_path}/r"]) == 1
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == got == json.loads((tmp_path / "r" / "run-first.json").read_text())
    page = (tmp_path / "r" / "run-first.html").read_text()
    assert page.count("<tr>") == len(summaries.SUMMARY) and "&quot;VALIDATION&quot;" in page and f"({got['sync_ms']} ms)" in page
    assert evidence.read_properties(f"{tmp_path}/r/run-first.properties")["staged_count"] == "4"
    again = jobs.Request("second", "REPLAY_ERRORS", {"source_execution": source.execution_id})
    assert jobs.run(store, again) == 0
    done = summaries.summary(store, "second")
    assert (done["selected_error_count"], done["source_open_errors"], done["source_resolved_errors"], done["next_mode"], done["faults"]) == (2, 0, 2, "BACKFILL", [])
    with pytest.raises(ValueError, match="has changed since the preflight: .*decision"):
        summaries.recheck(store, seen)
    assert cli.main(["PREFLIGHT", "--store", f"{tmp_path}/s", "--request", "BACKFILL"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["decision"] == "RUN"
    with pytest.raises(ValueError, match="no run of request"):
        summaries.summary(store, "third")


def test_columns_of_a_report_are_exact():
    summaries.exact(reversed(summaries.SUMMARY), summaries.SUMMARY)
    for names, why in ((["a"], "missing: \\['b'\\]"), (["a", "b", "c"], "not wanted: \\['c'\\]"), (["a", "b", "b"], "twice: \\['b'\\]")):
        with pytest.raises(ValueError, match=why):
            summaries.exact(names, ["a", "b"])


def test_evidence_of_a_benchmark_run(spark, tmp_path):
    args = ["BENCHMARK", "--store", f"{tmp_path}/s", "--rows", "30", "--evidence", f"{tmp_path}/e", "--chunk-size", "7"]
    assert cli.main([*args, "--request", "a", "--scenario", "initial"]) == 0
    assert cli.main([*args, "--request", "b", "--scenario", "no-op"]) == 0
    first, second = ({x["scenario"]: x for x in evidence.read(f"{tmp_path}/e")}[k] for k in ("initial", "no-op"))
    assert first["staging_digest"] == first["target_digest"] == second["staging_digest"] == second["target_digest"]
    assert (first["inserted_count"], second["no_op_count"], first["contradictions"], second["contradictions"]) == (30, 30, [], [])
    assert cli.main([*args, "--request", "c", "--scenario", "initial"]) == 1  # nothing to insert any more
    with pytest.raises(SystemExit):
        cli.main(["BENCHMARK", "--store", f"{tmp_path}/s", "--rows", "1000000", "--evidence", f"{tmp_path}/e", "--request", "d"])
    assert summaries.benchmark_evidence(Store(spark, f"{tmp_path}/s"), jobs.Request("a", "BENCHMARK").execution_id, "initial", 30, 42)["status"] == "COMPLETED"
    store = Store(spark, f"{tmp_path}/t")
    run = jobs.Run(store, jobs.Request("x", "BENCHMARK"))
    run.begin()
    with pytest.raises(RuntimeError):
        run.step("collect", lambda: (_ for _ in ()).throw(RuntimeError("broken")))
    assert len(run.state()["steps"]["collect"]) == 2
    assert synthetic_rows(spark, 1, 1).count() == 1
