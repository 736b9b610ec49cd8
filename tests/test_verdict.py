"""The verdict's figures against plain loops, and how often its steps read the staged rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import sync, verify
from tidemark.plans.store import settled

STAGED = "execution_id string, staging_key bigint, execution_sequence bigint, doi string, indexed_at bigint, content_hash string, source_error_key bigint"
ERRORS = "execution_id string, staging_key bigint, error_type string, status string"
TARGET = "doi string, source_indexed_at bigint, content_hash string"
ZERO = [0] * (len(schema.COUNTERS) - 1)


def readings(df) -> int:
    """How many leaves of a plan read the staged rows, as only they have an execution_sequence."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum("execution_sequence" in leaves.apply(k).toString() for k in range(leaves.size()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Executions with keys apart, a doi on a third of all rows and null dois; errors twice, resolved and open; a target with a doi twice."""
    r, rows, errors, base = random.Random(7), [], [], tmp_path_factory.mktemp("verdict")
    for ex in range(4):
        for k in range(60):
            key = 1000 * ex + 3 * k + 1
            doi = "hot" if k % 3 == 0 else None if k % 20 == 1 else f"d{r.randrange(30)}"
            rows.append((f"e{ex}", key, k + 1, doi, r.randrange(6), f"h{r.randrange(2)}", r.choice([None, 5])))
            if r.random() < 0.5:
                errors += [(f"e{ex}", key, "CONFLICT", r.choice(["OPEN", "RESOLVED"]))] * r.choice([1, 2])
    target = [(f"d{k}", r.randrange(6), f"h{r.randrange(2)}") for k in range(0, 30, 2)] + [("hot", 2, "h0"), ("hot", 9, "h1"), (None, 1, "h0")]
    for name, values, shape in (("staged", rows, STAGED), ("errors", errors, ERRORS), ("target", target, TARGET)):
        spark.createDataFrame(values, shape).write.parquet(f"{base}/{name}")
    return rows, errors, target, [spark.read.parquet(f"{base}/{name}") for name in ("staged", "errors", "target")]


def test_decisions_and_verdicts_read_the_staged_rows_once(spark, tables):
    staged, errors, target = tables[3]
    assert readings(sync.groups(staged, 10)) == 1
    decided = sync.decisions(staged, target, 10)
    assert readings(decided) == 1
    chunks = settled(sync.chunk_results(decided, staged, 10))
    expected = staged.select("execution_id").distinct().withColumn("expected_count", F.lit(60)).collect()
    expected = spark.createDataFrame(expected, "execution_id string, expected_count bigint")
    assert readings(verify.verdicts(staged, chunks, errors, target, expected, settle=settled)) == 1


def test_figures_are_those_of_plain_loops(spark, tables):
    rows, errors, target, (staged, open_errors, held) = tables
    opened = {(e, k) for e, k, _, status in errors if status == "OPEN"}
    there = {doi for doi, _, _ in target if doi is not None}
    chunks = spark.createDataFrame([(f"e{ex}", c + 1, 1000 * ex + 30 * c + 1, 1000 * ex + 30 * c + 28, 10, *ZERO) for ex in range(4) for c in range(6)], schema.CHUNKS)
    expected = spark.createDataFrame([(f"e{ex}", 60) for ex in range(5)], "execution_id string, expected_count bigint")
    got = {x.execution_id: x for x in verify.verdicts(staged, chunks, open_errors, held, expected, settle=settled).collect()}
    missing = {x.execution_id: x.missing for x in verify.missing_targets(staged.where("doi is not null"), open_errors, held).collect()}
    mismatches = {x.execution_id: x["count"] for x in verify.winner_mismatches(staged, open_errors, held).groupBy("execution_id").count().collect()}
    assert len(got) == 5 and (got["e4"].eligible, got["e4"].missing, got["e4"].reason) == (0, 0, "counts")
    for ex in ("e0", "e1", "e2", "e3"):
        own = [x for x in rows if x[0] == ex]
        fine = [x for x in own if (ex, x[1]) not in opened]
        winners = {}
        for x in fine:
            if x[3] not in winners or (x[4], -x[1]) > winners[x[3]][:2]:
                winners[x[3]] = (x[4], -x[1], x[5])
        wrong = sum(at < w[0] or (at == w[0] and h != w[2]) for doi, at, h in target if doi is not None and doi in winners for w in [winners[doi]])
        dois = {x[3] for x in own} - {None}
        assert (got[ex].eligible, got[ex].distinct_dois, got[ex].duplicates, got[ex].accounted) == (60, len(dois), 60 - len(dois), 60)
        assert got[ex].missing == len(set(winners) - there) and got[ex].mismatches == wrong
        assert got[ex].missing - (None in winners) == missing.get(ex, 0) and got[ex].mismatches == mismatches.get(ex, 0)
        assert got[ex].reason == "error counts"


def test_rows_in_conflict_are_those_of_all_groups(spark, tables):
    staged, _, held = tables[3]
    decided = settled(sync.decisions(staged, held, 10))
    keys = lambda df: sorted(x.staging_key for x in sync.conflict_errors(sync.row_outcomes(df, staged, 10)).collect())
    assert keys(sync.in_conflict(decided)) == keys(decided) != []
