import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import replay, reports, staging, verify, windows
from tidemark.plans import cli, evidence, jobs
from tidemark.plans.store import Store, settled
from tidemark.sources.generator import synthetic_rows
from tidemark.streaming import sync_stream


def test_benchmark_then_no_op_then_already_completed(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    rows = synthetic_rows(spark, 12, 42)
    first = jobs.Request("a", "BENCHMARK", {"rows": 12})
    assert jobs.run(store, first, rows=rows, chunk_size=5) == 0
    chunks = store.read("chunks").orderBy("chunk_sequence").collect()
    assert [c.inserted_count for c in chunks] == [5, 5, 2]
    before = {r.doi: r for r in store.read("target").collect()}
    assert jobs.run(store, first, rows=rows, chunk_size=5) == 3
    second = jobs.Request("b", "BENCHMARK", {"rows": 12})
    assert jobs.run(store, second, rows=rows, chunk_size=7) == 0
    assert sum(c.no_op_count for c in store.read("chunks").where(F.col("execution_id") == second.execution_id).collect()) == 12
    assert {r.doi: r for r in store.read("target").collect()} == before
    with pytest.raises(ValueError, match="frozen with other terms"):
        jobs.run(store, jobs.Request("a", "BENCHMARK", {"rows": 13}), rows=rows)


def test_a_run_goes_on_after_its_last_commit(spark, tmp_path, monkeypatch):
    store, request = Store(spark, f"{tmp_path}/s"), jobs.Request("r", "BENCHMARK", {})
    real = Store._replace
    seen = []

    def fails(self, text):
        seen.append(text)
        if len(seen) == 3:
            raise OSError("killed before the manifest was replaced")
        real(self, text)

    monkeypatch.setattr(Store, "_replace", fails)
    with pytest.raises(OSError):
        jobs.run(store, request, rows=synthetic_rows(spark, 20, 1), chunk_size=6)
    assert "target" not in store.manifest()["tables"]
    assert jobs.run(store, request, rows=synthetic_rows(spark, 20, 1), chunk_size=6) == 0
    assert store.read("target").count() == store.read("staging").count() == 20


def items(spark, *records):
    rows = [(k, json.dumps({"DOI": d, "title": [t], "indexed": {"date-time": f"2026-08-08T00:00:0{s}Z"}})) for k, (d, t, s) in enumerate(records)]
    return spark.createDataFrame(rows, "n bigint, json string").select("n", F.from_json("json", schema.ITEM).alias("item")), ["n"]


def test_conflict_fails_and_replay_resolves(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    source = jobs.Request("x", "INCREMENTAL", {"source": "s", "until": "2026-08-09T00:00:00Z"})
    assert jobs.run(store, source, items(spark, ("10.1/A", "t", 1), ("10.1/a ", "u", 1), ("10.1/B", "v", 0))) == 1
    assert store.manifest()["facts"].get("mark:s") is None
    errors = store.read("errors").collect()
    assert len(errors) == 2 and {e.status for e in errors} == {"OPEN"}
    # each error replayed in a chunk of its own: the first inserts, the second is in conflict with it
    again = jobs.Request("y", "REPLAY_ERRORS", {"source_execution": source.execution_id})
    assert jobs.run(store, again, chunk_size=1) == 1
    after = {e.error_key: (e.status, e.replay_count) for e in store.read("errors").where(F.col("execution_id") == source.execution_id).collect()}
    assert set(after.values()) == {("OPEN", 1)}
    clean = jobs.Request("z", "INCREMENTAL", {"source": "s", "until": "2026-08-10T00:00:00Z"})
    assert jobs.run(store, clean, items(spark, ("10.1/C", "t", 2), ("10.1/B", "v", 0))) == 0
    assert store.manifest()["facts"]["mark:s"] == "2026-08-10T00:00:00Z"


def test_a_bad_record_stages_nothing(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    with pytest.raises(ValueError, match="DOI is required"):
        jobs.run(store, jobs.Request("x", "BACKFILL"), items(spark, ("10.1/A", "t", 1), (" ", "u", 1)))
    assert "staging" not in store.manifest()["tables"]


def test_resolution_of_a_completed_replay(spark):
    errors = spark.createDataFrame([(1, "OPEN", 0, None), (2, "RESOLVED", 0, "t0"), (3, "OPEN", 0, None)], "error_key bigint, status string, replay_count int, resolved_at string")
    replayed = spark.createDataFrame([(1,), (2,)], "source_error_key bigint")
    assert {r.error_key: (r.status, r.resolved_at) for r in replay.resolved(errors, replayed, True, F.lit("t1")).collect()} == {1: ("RESOLVED", "t1"), 2: ("RESOLVED", "t0"), 3: ("OPEN", None)}
    assert replay.resolved(errors, replayed, False, F.lit("t1")) is errors


def test_stream_applies_each_batch_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    for k, (a, b) in enumerate(((1, 10), (5, 15))):
        synthetic_rows(spark, b, 7, start=a).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{k}")
    for k in range(2):
        src = spark.readStream.schema(schema.STAGING).parquet(f"{tmp_path}/in{k}")
        sync_stream.start(src, store, f"{tmp_path}/cp{k}", f"s{k}").awaitTermination(120)
    batch = spark.read.parquet(f"{tmp_path}/in1")
    version = store.manifest()["version"]
    sync_stream.apply_batch(store, batch, 0, "s1")
    assert store.manifest()["version"] == version and store.read("target").count() == 15
    totals = {c.execution_id: (c.inserted_count, c.no_op_count) for c in store.read("chunks").collect()}
    assert totals == {"s0": (10, 0), "s1": (5, 6)}


def test_dense_sequence_over_many_partitions(spark):
    df = staging.dense_sequence(spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("a"), "id"), ["a", "id"], start=5, settle=settled)
    rows = df.orderBy("a", "id").collect()
    assert [r.execution_sequence for r in rows] == list(range(6, 1006))


def test_day_plan_against_a_plain_rule(spark):
    r, day = random.Random(11), timedelta(days=1)
    first = datetime(2024, 2, 26)
    ranges = [(a, a + timedelta(microseconds=r.choice((1, 3_600_000_000, 86_400_000_000, r.randrange(1, 5 * 86_400_000_000))))) for a in (first + timedelta(microseconds=r.randrange(6 * 86_400_000_000)) for _ in range(30))]
    ranges += [(first, first + day), (first, first + 3 * day), (first + day / 2, first + day), (first, first + timedelta(microseconds=1))]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(ranges)], "k int, range_from timestamp_ntz, range_until timestamp_ntz")
    want = []
    for k, (a, b) in enumerate(ranges):
        n = 0
        while a < b:
            end = min(datetime(a.year, a.month, a.day) + day, b)
            want.append((k, n, a, end))
            a, n = end, n + 1
    got = windows.day_plan(df).select("k", "window_sequence", "window_from", "window_until")
    assert sorted(map(tuple, got.collect())) == want
    for bad in ((first, first), (first + day, first)):
        with pytest.raises(Exception, match="must increase"):
            windows.day_plan(spark.createDataFrame([bad], "range_from timestamp_ntz, range_until timestamp_ntz")).collect()


def test_trend_of_samples_against_a_plain_rule(spark):
    r, series = random.Random(6), {}
    for k in range(60):
        n, slope, base = r.choice((3, 40, 63, 64, 65, 90, 200)), r.choice((-1, 0, 0.2, 0.5, 1, 2)), r.randrange(1, 400)
        series[f"s{k}"] = [int((base + slope * i / 3 + r.random() * 4) * (1 << 20)) for i in range(n)]
    df = spark.createDataFrame([(g, i, v) for g, values in series.items() for i, v in enumerate(values)], "g string, k int, v bigint")
    for row in reports.sample_trend(df, ["g"], "k", "v").collect():
        last = series[row.g][-64:]
        first, end = min(last[: 16 if len(last) == 64 else max(0, len(last) - 48)], default=None), min(last[-16:])
        assert (row.samples, row.peak, row.first_floor, row.last_floor) == (len(last), max(last), first, end)
        assert bool(row.plateau) == (len(last) == 64 and end - first <= max(8 << 20, first / 10))


def test_a_run_appends_and_leaves_other_files_alone(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    stamp = lambda: {str(p): p.stat().st_mtime_ns for name in ("staging", "chunks", "errors") for p in (tmp_path / "s" / name).rglob("*.parquet")}
    assert jobs.run(store, jobs.Request("a", "BENCHMARK"), rows=synthetic_rows(spark, 30, 1)) == 0
    before = stamp()
    assert jobs.run(store, jobs.Request("b", "BENCHMARK"), rows=synthetic_rows(spark, 40, 1)) == 0
    after = stamp()
    assert before and before.items() <= after.items() and set(store.manifest()["tables"]["staging"][:1]) == {f"staging/{next(p for p in before if '/staging/' in p).split('/staging/')[1].split('/')[0]}"}
    keys = [r.staging_key for r in store.read("staging").collect()]
    assert len(set(keys)) == 70 and store.read("chunks").count() == 2


def test_a_replay_that_fails_counts_its_errors_once(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/s")
    source = jobs.Request("x", "BACKFILL")
    assert jobs.run(store, source, items(spark, ("10.1/A", "t", 1), ("10.1/a", "u", 1))) == 1
    real, seen = Store._replace, []

    def fails(self, text):
        seen.append(text)
        if len(seen) == 2:
            raise OSError("killed")
        real(self, text)

    again = jobs.Request("y", "REPLAY_ERRORS", {"source_execution": source.execution_id})
    monkeypatch.setattr(Store, "_replace", fails)
    with pytest.raises(OSError):
        jobs.run(store, again)
    assert {e.replay_count for e in store.read("errors").collect()} == {0}
    jobs.run(store, again)
    assert {e.replay_count for e in store.read("errors").where(F.col("execution_id") == source.execution_id).collect()} == {1}


def test_only_a_synchronised_run_is_verified(spark, tmp_path):
    run = jobs.Run(Store(spark, f"{tmp_path}/s"), jobs.Request("x", "BENCHMARK"))
    with pytest.raises(ValueError, match="can't be verified"):
        run.verify()
    run.begin()
    with pytest.raises(ValueError, match="PENDING can't be verified"):
        run.verify()


def test_requests_are_looked_at_whole():
    for bad in ("", "-a", "a b", "a\n", "x" * 101, "a;b"):
        with pytest.raises(ValueError, match="request id"):
            jobs.Request(bad, "BACKFILL")
    for name, value in (("source", "a b"), ("until", "2026-08-08"), ("source_execution", "1"), ("rows", "0"), ("seed", "-1")):
        with pytest.raises(ValueError, match=name):
            jobs.Request("a", "BACKFILL", {name: value})


def test_a_mark_without_an_end_is_the_start_of_the_run(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    for k in range(2):
        request = jobs.Request(f"r{k}", "INCREMENTAL", {"source": "s"})
        assert jobs.run(store, request, items(spark, (f"10.1/{k}", "t", 1))) == 0
        facts = store.manifest()["facts"]
        assert facts["mark:s"] == facts[f"run:{request.execution_id}"]["started"]
    assert facts[f"run:{request.execution_id}"]["since"] < facts["mark:s"]


def test_a_collected_run_from_the_command_line(spark, tmp_path):
    page = lambda k, dois: {"status": "ok", "message": {"total-results": 5, "next-cursor": str(k + 1), "items": [{"DOI": f"10.5/{d}", "indexed": {"date-time": "2026-08-08T00:00:00Z"}} for d in dois]}}
    for window, dois in enumerate((range(5), range(5, 10))):
        (tmp_path / "in" / str(window)).mkdir(parents=True)
        (tmp_path / "in" / str(window) / "0.json").write_text(json.dumps(page(0, dois)))
    args = ["INCREMENTAL", "--store", f"{tmp_path}/s", "--request", "r", "--folder", f"{tmp_path}/in", "--since", "2026-08-08T06:00:00Z", "--until", "2026-08-10T00:00:00Z", "--limit", "7"]
    assert cli.main(args) == 0 and cli.main(args) == 3
    store = Store(spark, f"{tmp_path}/s")
    assert sorted(r.doi for r in store.read("staging").collect()) == [f"10.5/{k}" for k in range(7)]
    facts = store.manifest()["facts"]
    assert facts["mark:default"] == "2026-08-10T00:00:00Z"
    run = next(v for k, v in facts.items() if k.startswith("run:"))
    assert (run["collected"]["windows"], run["collected"]["reported_total"], run["collected"]["rows"], run["stopped"]) == (2, 10, 7, "limit")


def test_page_files_come_in_the_order_of_their_numbers(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for k in (1, 2, 10):
        (tmp_path / "p" / f"{k}.json").write_text(json.dumps({"status": "ok", "message": {"total-results": 3, "items": [{"DOI": f"10.6/{k}", "indexed": {"date-time": "2026-08-08T00:00:00Z"}}]}}))
    assert cli.main(["BACKFILL", "--store", f"{tmp_path}/s", "--request", "r", "--pages", f"{tmp_path}/p"]) == 0
    rows = Store(spark, f"{tmp_path}/s").read("staging").orderBy("execution_sequence").collect()
    assert [r.doi for r in rows] == ["10.6/1", "10.6/2", "10.6/10"]
    (tmp_path / "p" / "3.json").write_text(json.dumps({"status": "error", "message": {"items": []}}))
    with pytest.raises(Exception, match="not a page"):
        cli.main(["BACKFILL", "--store", f"{tmp_path}/t", "--request", "r", "--pages", f"{tmp_path}/p"])


def test_coverage_is_the_same_over_any_partitions(spark):
    r, chunks, rows = random.Random(3), [], []
    for ex, n in (("a", 400), ("b", 90), ("c", 1)):
        keys = sorted(r.sample(range(1, 10_000), n))
        rows += [(ex, k) for k in keys]
        for c in range(0, n, 40):
            part = keys[c : c + 40]
            chunks.append((ex, c // 40 + 1, part[0], part[-1], len(part) + (ex == "b" and c == 40), *[0] * 6))
    chunks = spark.createDataFrame(chunks, schema.CHUNKS)
    staged = spark.createDataFrame(rows, "execution_id string, staging_key bigint").repartition(7)
    got = verify.coverage(chunks, staged, settled).collect()
    assert len(got) == 14 and [(x.execution_id, x.chunk_sequence, x.violation) for x in got if x.violation] == [("b", 2, "content")]
    assert sum(x.rows_in_range for x in got) == len(rows)


def test_evidence_and_gates(tmp_path):
    assert evidence.semantics("initial", 5, {"inserted_count": 5, "no_op_count": 0}, "COMPLETED") == []
    assert evidence.semantics("no-op", 5, {"inserted_count": 1, "no_op_count": 4}, "COMPLETED")
    done = [{"scenario": s, "rows": 100_000, "seed": 1, "status": "COMPLETED"} for s in evidence.SCENARIOS]
    assert evidence.million_gate(1_000_000, done, 1) == [] and evidence.million_gate(1_000_000, done[:1], 1)
    evidence.write(f"{tmp_path}/e", {"scenario": "initial", "rows": 5})
    assert evidence.read(f"{tmp_path}/e")[0]["rows"] == 5
    evidence.outcome_file(f"{tmp_path}/o", 2, "sync", "a=b\nc", "BACKFILL", "e")
    assert evidence.read_properties(f"{tmp_path}/o")["requestId"] == "a_b_c"
