"""The store: buckets, commits by several writers, versions, upkeep."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import changes
from tidemark.plans import jobs
from tidemark.plans.store import Conflict, Store
from tidemark.sources.generator import synthetic_rows
from tidemark.streaming import sync_stream


def kv(spark, pairs):
    return spark.createDataFrame(list(pairs), "k string, v bigint")


def put(store, spark, pairs, base=None):
    """Upserts pairs into table t, reading and writing the buckets that they touch."""
    at, new = base or store.manifest(), kv(spark, pairs)
    own = store.touched("t", new, "k", at)
    old = store.read("t", "k string, v bigint", at, buckets=own).join(new, "k", "left_anti")
    return store.commit(upserts={"t": (old.unionByName(new), "k", own, own)}, base=at)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_an_upsert_leaves_other_buckets_alone(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", buckets=16)
    put(store, spark, [(f"k{i}", i) for i in range(200)])
    first, before = store.manifest()["buckets"]["t"]["at"], files(tmp_path)
    put(store, spark, [("k3", -3), ("new", 1)])
    second = store.manifest()["buckets"]["t"]["at"]
    changed = {b for b in second if first.get(b) != second[b]}
    assert len(first) == 16 and 1 <= len(changed) <= 2
    assert before.items() <= files(tmp_path).items()
    got = {r.k: r.v for r in store.read("t").collect()}
    assert got == {f"k{i}": i for i in range(200)} | {"k3": -3, "new": 1}
    at = store.manifest()
    own = store.touched("t", kv(spark, [("k3", 0)]), "k", at)
    paths = store.read("t", at=at, buckets=own).inputFiles()
    assert len(own) == 1 and paths and all(f"bucket={own[0]}/" in p for p in paths)


def test_a_run_reads_and_writes_the_buckets_of_its_rows(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", buckets=32)
    assert jobs.run(store, jobs.Request("a", "BENCHMARK"), rows=synthetic_rows(spark, 300, 1)) == 0
    first, before = store.manifest()["buckets"]["target"]["at"], files(tmp_path / "s" / "target")
    assert jobs.run(store, jobs.Request("b", "BENCHMARK"), rows=synthetic_rows(spark, 2, 1)) == 0  # nothing new
    assert store.manifest()["buckets"]["target"]["at"] == first and files(tmp_path / "s" / "target") == before
    assert jobs.run(store, jobs.Request("c", "BENCHMARK"), rows=synthetic_rows(spark, 301, 1, start=300)) == 0  # two rows, one of them new
    now = store.manifest()["buckets"]["target"]["at"]
    assert sum(first.get(b) != p for b, p in now.items()) == 1 and store.read("target").count() == 301


def test_writers_of_unlike_things_both_stand(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", buckets=64)
    put(store, spark, [(f"k{i}", i) for i in range(300)])
    base = store.manifest()
    assert store.touched("t", kv(spark, [("k1", 0)]), "k", base) != store.touched("t", kv(spark, [("k2", 0)]), "k", base)
    put(store, spark, [("k1", -1)], base)
    put(store, spark, [("k2", -2)], base)
    got = {r.k: r.v for r in store.read("t").collect()}
    assert (got["k1"], got["k2"], len(got)) == (-1, -2, 300)
    with pytest.raises(Conflict, match="t, bucket"):
        put(store, spark, [("k1", -5)], base)
    store.commit(facts={"n": 1}, base=base)
    with pytest.raises(Conflict, match="n"):
        store.commit(facts={"n": 2}, base=base)
    store.commit(more={"log": kv(spark, [("a", 1)])}, base=base)
    store.commit(more={"log": kv(spark, [("b", 2)])}, base=base)
    assert store.read("log").count() == 2 and store.versions() == list(range(1, 7))
    with pytest.raises(Conflict, match="another writer"):
        store.commit(facts={"m": 1}, expect=3)


def test_runs_at_the_same_time_are_both_kept(spark, tmp_path):
    errors = []

    def work(name, start):
        try:
            assert jobs.run(Store(spark, f"{tmp_path}/s"), jobs.Request(name, "BENCHMARK"), rows=synthetic_rows(spark, start + 39, 3, start=start)) == 0
        except BaseException as e:  # noqa: BLE001
            errors.append(e)

    both = [threading.Thread(target=work, args=x) for x in (("a", 1), ("b", 21))]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert not errors
    store = Store(spark, f"{tmp_path}/s")
    assert store.read("target").count() == 60 and store.read("staging").count() == 80
    assert store.read("staging").select("staging_key").distinct().count() == 80
    totals = store.read("chunks").agg(F.sum("inserted_count"), F.sum("no_op_count")).first()
    assert tuple(totals) == (60, 20)
    assert {f["status"] for k, f in store.manifest()["facts"].items() if k.startswith("run:")} == {"COMPLETED"}


def test_a_counter_of_many_writers_loses_nothing(spark, tmp_path):
    def add():
        own = Store(spark, f"{tmp_path}/s")
        for _ in range(10):
            own.transact(lambda at: own.commit(facts={"n": at["facts"].get("n", 0) + 1}, base=at), attempts=200)

    threads = [threading.Thread(target=add) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = Store(spark, f"{tmp_path}/s")
    assert store.manifest()["facts"]["n"] == 40 and store.versions() == list(range(1, 41))


def test_versions_are_read_and_compared(spark, tmp_path):
    store, rng, state, states = Store(spark, f"{tmp_path}/s", buckets=8), random.Random(2), {}, {0: {}}
    for _ in range(4):
        new = {f"k{rng.randrange(30)}": rng.randrange(3) for _ in range(12)}
        v = put(store, spark, new.items())
        state = state | new
        states[v] = state
    for v, want in states.items():
        if v:
            assert {r.k: r.v for r in store.read("t", at=store.manifest(v)).collect()} == want
    for a in states:
        for b in states:
            if a < b:
                got = {(r.k, r.change, r.v) for r in store.changes("t", "k", a, b).collect()}
                want = {(k, "INSERTED" if k not in states[a] else "UPDATED", v) for k, v in states[b].items() if states[a].get(k) != v}
                assert got == want


def test_row_changes_with_nulls(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (None, "z", 2), (4, None, None)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 5), (2, "y", 1), (None, "z", None), (5, None, None)], "k int, s string, n int")
    got = {tuple(r) for r in changes.row_changes(a, b, ["k"]).collect()}
    assert got == {(1, "UPDATED", "x", 5), (None, "UPDATED", "z", None), (4, "DELETED", None, None), (5, "INSERTED", None, None)}


def test_many_commits_are_merged_and_cleaned(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    for k in range(30):
        store.commit(more={"log": kv(spark, [(f"r{k}", k)])}, tag=f"run{k}")
    for k in range(170):
        store.commit(facts={"k": k})
    at = store.manifest()
    assert len(at["tables"]["log"]) == 30 and [r.v for r in store.read("log", tag="run7").collect()] == [7]
    assert store.compact("log") == 30 and store.compact("log") == 0
    assert len(store.manifest()["tables"]["log"]) == 1 and store.manifest()["tags"] == {}
    assert sorted(r.v for r in store.read("log", tag="run7").collect()) == list(range(30))
    assert store.read("log", at=at).count() == 30  # a reader of an older version
    assert store.vacuum(keep=2, grace=3600) == 0  # too young to go
    time.sleep(1.1)
    assert store.vacuum(keep=2, grace=1) == 0 and store.read("log", at=at).count() == 30  # the version before names them
    store.commit(facts={"k": -1})
    store.commit(facts={"k": -2})
    assert store.vacuum(keep=2, grace=1) == 30 and len(store.versions()) == 2
    assert store.read("log").count() == 30 and len(list((tmp_path / "s" / "log").glob("v*"))) == 1


def test_clean_up_keeps_the_buckets_that_are_named(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", buckets=8)
    put(store, spark, [(f"k{i}", i) for i in range(100)])
    for n in range(5):
        put(store, spark, [("k3", n)])
    time.sleep(1.1)
    assert store.vacuum(keep=1, grace=0.5) == 5  # the bucket as it was in five versions
    assert {r.k: r.v for r in store.read("t").collect()} == {f"k{i}": i for i in range(100)} | {"k3": 4}
    assert len(store.manifest()["buckets"]["t"]["at"]) == 8


def test_a_stream_numbers_its_errors_after_those_of_runs(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    one = synthetic_rows(spark, 1, 5).select([F.col(f.name).cast(f.dataType) if f.name in synthetic_rows(spark, 1, 5).columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.STAGING])
    both = one.unionByName(one.withColumns({"content_hash": F.lit("other"), "execution_sequence": F.lit(2).cast("bigint")}))
    source = jobs.Request("x", "BACKFILL")
    assert jobs.run(store, source, rows=both) == 1
    sync_stream.apply_batch(store, both.withColumn("staging_key", F.col("execution_sequence")), 0, "s")
    keys = [r.error_key for r in store.read("errors").orderBy("error_key").collect()]
    assert keys == [1, 2, 3, 4]
    jobs.run(store, jobs.Request("y", "REPLAY_ERRORS", {"source_execution": source.execution_id}), chunk_size=1)
    counts = {r.execution_id: r.n for r in store.read("errors").groupBy("execution_id").agg(F.sum("replay_count").alias("n")).collect()}
    assert counts["s"] == 0 and counts[source.execution_id] == 2
