"""Overlapping ranges and digest trees against plain rules."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals, tree_digest


@pytest.mark.parametrize(("width", "heavy", "seed"), [(1, 200_000, 1), (7, 5, 2), (1000, 3, 3)])
def test_points_in_ranges_against_all_pairs(spark, width, heavy, seed):
    r = random.Random(seed)
    points = [(k, r.choice("ab"), r.choice([r.randrange(-500, 500), 7, None])) for k in range(300)]
    ranges = [(k, r.choice(["a", "b", None]), a, a + r.choice([-1, 0, 1, 5, 64, 900])) for k in range(60) for a in [r.randrange(-600, 600)]]
    ranges += [(99, "a", -(10**15), 10**15), (98, "a", None, 5)]
    p = spark.createDataFrame(points, "p long, g string, at long")
    q = spark.createDataFrame(ranges, "q long, g string, first long, last long")
    out = intervals.in_ranges(p, "at", q, "first", "last", ["g"], width, heavy)
    got = sorted((x.p, x.q) for x in out.collect())
    assert got == sorted((a[0], b[0]) for a in points for b in ranges if a[2] is not None and a[1] == b[1] and b[2] is not None and b[2] <= a[2] <= b[3])
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
    without = intervals.in_ranges(p.drop("g"), "at", q.drop("g"), "first", "last", (), width, heavy)
    assert without.count() == sum(a[2] is not None and b[2] is not None and b[2] <= a[2] <= b[3] for a in points for b in ranges)
    assert intervals.in_ranges(p, "at", q.limit(0), "first", "last", ["g"]).count() == 0


def test_contents_of_overlapping_ranges(spark):
    rows = spark.createDataFrame([(k,) for k in (1, 2, 3, 5, 8, 8)], "k long")
    ranges = spark.createDataFrame([(1, 3), (2, 8), (4, 4), (8, 9), (2, 8)], "a long, b long")
    got = [tuple(x) for x in intervals.range_contents(ranges, "a", "b", rows, "k").select("a", "b", "rows_in_range", "least", "most").collect()]
    assert sorted(got, key=str) == sorted([(1, 3, 3, 1, 3), (2, 8, 5, 2, 8), (2, 8, 5, 2, 8), (4, 4, 0, None, None), (8, 9, 2, 8, 8)], key=str)


@pytest.mark.parametrize(("heavy", "seed"), [(200_000, 1), (40, 2), (3, 3), (1, 4)])
def test_contents_against_all_pairs_over_any_cuts(spark, heavy, seed):
    r = random.Random(seed)
    keys = [0.0, -0.0, float("nan"), 2.5, None]
    rows = [(r.choice(keys), r.choice("ab"), r.choice([r.randrange(-500, 500), 7, None])) for _ in range(400)]
    ranges = [(k, r.choice(keys), r.choice("ab"), a, a + r.choice([-1, 0, 1, 5, 64, 900])) for k in range(100) for a in [r.randrange(-600, 600)]]
    ranges += [(200 + k, 2.5, "a", 7, 7 + k % 3) for k in range(60)] + [(99, 2.5, "a", -(2**62), 2**62), (98, 2.5, "b", None, 5), (99, 2.5, "a", -(2**62), 2**62)]
    p, q = spark.createDataFrame(rows, "f double, g string, at int"), spark.createDataFrame(ranges, "q long, f double, g string, first long, last long")
    own = ["_first", "_last", "_at", "_n", "_bin", "_end", "_row", "_k0", "_held"]  # the names inside don't touch columns of the ranges
    q = q.withColumns({c: F.lit(-1) for c in own})
    for by in (["f", "g"], ["g"], []):
        key = lambda f, g: tuple(str(f + 0.0 if f is not None else None) if c == "f" else g for c in by)
        want = []
        for x in ranges:
            held = [a for f, g, a in rows if a is not None and x[3] is not None and key(f, g) == key(*x[1:3]) and "None" not in key(f, g) and x[3] <= a <= x[4]]
            want.append((x[0], len(held), min(held, default=None), max(held, default=None)))
        out = intervals.range_contents(q, "first", "last", p, "at", by, heavy=heavy)
        found = out.select("q", "rows_in_range", "least", "most", *own).collect()
        assert sorted((tuple(x)[:4] for x in found), key=str) == sorted(want, key=str)
        assert all(set(x[4:]) == {-1} for x in found)
        assert [f.dataType.simpleString() for f in out.select("rows_in_range", "least", "most").schema] == ["bigint", "int", "int"]


def most_rows(plan):
    """The greatest number of rows that a step of an executed plan gave."""
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else []
    found, children = plan.metrics().get("numOutputRows"), plan.children()
    return max([found.get().value() if found.isDefined() else 0, *map(most_rows, inner), *(most_rows(children.apply(j)) for j in range(children.length()))])


@pytest.mark.parametrize("heavy", [200_000, 100])
def test_no_row_for_each_pair_of_ranges_and_rows(spark, heavy):
    rows, ranges = spark.range(1000), spark.range(1000).select((-F.col("id")).alias("a"), (F.col("id") + 1000).alias("b"))
    out = intervals.range_contents(ranges, "a", "b", rows, "id", heavy=heavy)
    assert {x.rows_in_range for x in out.collect()} == {1000}
    assert 1000 <= most_rows(out._jdf.queryExecution().executedPlan()) < 20_000


def plain_tree(rows, width, fan, levels):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    text = lambda row: "".join("-" if v is None else f"{len(str(v))}:{v}" for v in row)
    groups = {}
    for row in rows:
        groups.setdefault(row[0] // width, []).append((row[0], sha(text(row))))
    now = {}
    for node, items in groups.items():
        now[node] = (len(items), sha(",".join(f"{h}x{items.count((k, h))}" for k, h in sorted(set(items)))))
    out = [(0, k, *v) for k, v in now.items()]
    for level in range(1, levels + 1):
        up = {}
        for k in sorted(now):
            up.setdefault(0 if level == levels else k // fan, []).append(now[k])
        now = {k: (sum(n for n, _ in v), sha(",".join(d for _, d in v))) for k, v in up.items()}
        out += [(level, k, *v) for k, v in now.items()]
    return sorted(out)


def test_tree_is_the_same_over_any_partitioning_and_finds_what_differs(spark):
    r = random.Random(4)
    rows = [(k, r.choice(["x", "", None]), r.randrange(3)) for k in r.sample(range(-300, 2000), 700)]
    rows += [rows[0]] * 3 + [(rows[1][0], "other", 1)]
    df = spark.createDataFrame(rows, "k long, s string, n int")
    want = plain_tree(rows, 16, 4, 3)
    for parts in (1, 9):
        assert sorted(map(tuple, tree_digest.tree(df.repartition(parts), "k", ["k", "s", "n"], 16, 4, 3).collect())) == want
    auto = tree_digest.tree(df, "k", ["k", "s", "n"], 16, 4)
    top = auto.orderBy(F.desc("level")).first()
    assert (top.node, top.n) == (0, len(rows)) and auto.where(F.col("level") == top.level).count() == 1
    changed = [x if x[0] not in (rows[5][0], rows[6][0]) else (x[0], "new", 9) for x in rows if x[0] != rows[7][0]] + [(5000, "far", 1)]
    got = tree_digest.differing_ranges(df, spark.createDataFrame(changed, "k long, s string, n int"), "k", ["k", "s", "n"], 16).collect()
    assert {x.first_key // 16 for x in got} == {rows[j][0] // 16 for j in (5, 6, 7)} | {5000 // 16}
    assert tree_digest.tree(df.limit(0), "k", ["k"]).count() == 0
    with pytest.raises(Exception, match="without a key"):
        tree_digest.leaves(spark.createDataFrame([(None, "x")], "k long, s string"), "k", ["s"]).collect()


def test_a_shifted_value_changes_the_root(spark):
    a = spark.createDataFrame([(1, "ab", None), (2, None, "c")], "k long, s string, t string")
    b = spark.createDataFrame([(1, None, "ab"), (2, "c", None)], "k long, s string, t string")
    root = lambda df: tree_digest.tree(df, "k", ["s", "t"]).orderBy(F.desc("level")).first().digest
    assert root(a) != root(b)
