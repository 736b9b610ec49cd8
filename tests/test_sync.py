import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import sync, verify

COLUMNS = "execution_id string, staging_key bigint, execution_sequence bigint, doi string, indexed_at bigint, content_hash string"
TARGET = "id string, doi string, content_hash string, source_indexed_at bigint, created_at string, updated_at string"


def by_hand(rows, target, size):
    """Chunk after chunk over a dictionary: counters by chunk, and the target at the end."""
    state, out = dict(target), []
    for k in range(0, len(rows), size):
        count, grouped = Counter(), {}
        for r in rows[k : k + size]:
            grouped.setdefault(r[3], []).append(r)
        for doi, own in grouped.items():
            latest = max(r[4] for r in own)
            tied = [r for r in own if r[4] == latest]
            if len({r[5] for r in tied}) > 1:
                count["CONFLICT"] += len(own)
                continue
            count["SUPERSEDED"] += len(own) - len(tied)
            count["NO_OP"] += len(tied) - 1
            w, now = min(tied, key=lambda r: r[1]), state.get(doi)
            if now is None:
                what = "INSERTED"
            elif latest < now[0]:
                what = "SUPERSEDED"
            elif latest == now[0]:
                what = "NO_OP" if w[5] == now[1] else "CONFLICT"
            else:
                what = "INDEX_ADVANCED" if w[5] == now[1] else "UPDATED"
            if what in ("INSERTED", "INDEX_ADVANCED", "UPDATED"):
                state[doi] = (latest, w[5])
            count[what] += 1
        out.append(count)
    return out, state


def compare(spark, triples, target, size):
    rows = [("e", i + 1, i + 1, f"d{d}", t, f"h{h}") for i, (d, t, h) in enumerate(triples)]
    df = spark.createDataFrame(rows, COLUMNS)
    old = spark.createDataFrame([(f"id{k}", k, h, t, "old", "old") for k, (t, h) in target.items()], TARGET)
    decided = sync.decisions(df, old, size).cache()
    counts, state = by_hand(rows, target, size)
    got = {r.chunk_sequence: r for r in sync.chunk_results(decided, df, size).collect()}
    for k, want in enumerate(counts):
        assert {x: got[k + 1][f"{x.lower()}_count"] for x in sync.OUTCOMES} == {x: want[x] for x in sync.OUTCOMES}
    outcomes = Counter(r.outcome for r in sync.row_outcomes(decided, df, size).collect())
    assert outcomes == +sum(counts, Counter())
    new = sync.upserted(old, df, decided, ["doi", "content_hash"], F.lit("new")).collect()
    assert {r.doi: (r.source_indexed_at, r.content_hash) for r in new} == state
    for r in new:
        if r.doi in target:
            assert r.id == f"id{r.doi}" and r.created_at == "old"
    decided.unpersist()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 1)), min_size=1, max_size=40), st.integers(1, 9))
def test_any_rows_match_a_sequential_run(spark, triples, size):
    compare(spark, triples, {"d0": (2, "h0"), "d9": (5, "h1")}, size)


@pytest.mark.parametrize("size", [10, 100, 1500])
def test_many_rows_match_a_sequential_run(spark, size):
    r = random.Random(size)
    compare(spark, [(r.randrange(60), r.randrange(30), r.randrange(2)) for _ in range(1500)], {}, size)


def test_six_outcomes_and_group_conflict(spark):
    target = {"d1": (5, "h0"), "d2": (5, "h0"), "d3": (5, "h0"), "d4": (5, "h0"), "d5": (5, "h0")}
    compare(spark, [(0, 1, 0), (1, 4, 0), (2, 5, 0), (3, 5, 1), (4, 6, 0), (5, 6, 1)], target, 10)
    compare(spark, [(0, 1, 0), (0, 2, 0), (0, 2, 1)], {}, 10)


def test_empty_input(spark):
    df = spark.createDataFrame([], COLUMNS)
    assert sync.chunk_results(sync.decisions(df), df).count() == 0
    assert verify.outcome_totals(sync.chunk_results(sync.decisions(df), df)).first()["accounted"] == 0
