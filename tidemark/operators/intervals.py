"""Points in ranges, where ranges may overlap and be of any length, by bins in place of a nested loop.

A range of length n belongs to the level whose bins are at least n wide, so it touches two bins of that level at most; a
point stands in one bin of each level that is in use. Both meet on (level, bin), and a pair in exactly one bin. A bin with
more points than `heavy` is split: its points are dealt to parts, and its ranges stand in each of them.

What a range holds (`range_contents`) needs no pairs: it is looked up at both ends in the running counts of its key's places.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAVY = 200_000


def _level(length: Column, width: int) -> Column:
    """The least k with width * 2**k >= length."""
    more = F.floor((length - 1).cast("decimal(38,0)") / width).cast("bigint")  # whole widths besides the first
    return F.when(more == 0, 0).otherwise(F.length(F.bin(more))).cast("int")


def _bin(x: Column, level: Column, width: int) -> Column:
    return F.call_function("shiftright", F.floor(x.cast("decimal(38,0)") / width).cast("bigint"), level)


def in_ranges(points: DataFrame, at: str, ranges: DataFrame, first: str, last: str, keys: Sequence[str] = (), width: int = 1, heavy: int = HEAVY) -> DataFrame:
    """Each point with each range first <= at <= last (whole numbers) of the same keys: the columns of both, keys once.

    Other columns must have unlike names. A null place, bound or key, and a range that ends before it begins, meet nothing.
    width is the least width of a bin: about the length of the shortest ranges.
    """
    keys = list(keys)
    there = ranges.where(F.col(first) <= F.col(last)).withColumn("_level", _level(F.col(last) - F.col(first) + 1, width))
    levels = [r[0] for r in there.select("_level").distinct().collect()]  # 64 at most
    if not levels:
        return points.join(ranges.limit(0), keys, "inner") if keys else points.limit(0).join(ranges.limit(0), F.lit(True))
    on = [*keys, "_level", "_bin"]
    p = points.where(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in sorted(levels)]))).withColumn("_bin", _bin(F.col(at), F.col("_level"), width))
    r = there.withColumn("_bin", F.explode(F.array_distinct(F.array(_bin(F.col(first), F.col("_level"), width), _bin(F.col(last), F.col("_level"), width)))))
    crowded = p.groupBy(*on).agg(F.ceil(F.count("*") / heavy).cast("int").alias("_parts")).where("_parts > 1")
    parts = F.coalesce("_parts", F.lit(1))
    p = p.join(crowded, on, "left").withColumn("_part", F.pmod(F.xxhash64(*points.columns), parts).cast("int")).drop("_parts")
    r = r.join(crowded, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return p.join(r, [*on, "_part"]).where((F.col(at) >= F.col(first)) & (F.col(at) <= F.col(last))).drop("_level", "_bin", "_part")


def _keyed(df: DataFrame, keys: Sequence[str], **more: Column) -> tuple[list[str], DataFrame]:
    """Its keys under names of our own (one constant if there is none), floating ones as text so that equal ones look alike, and more columns of df."""
    own = {f"_k{j}": (F.col(k) + 0.0).cast("string") if df.schema[k].dataType.typeName() in ("double", "float") else F.col(k) for j, k in enumerate(keys)} or {"_k0": F.lit(0)}
    return list(own), df.select(*[c.alias(name) for name, c in (own | more).items()])


def _with_bin(df: DataFrame, keys: Sequence[str], cuts: DataFrame | None, **places: str) -> DataFrame:
    """For each name=place the number of the key's cuts that aren't above that place: first by every _step-th cut, then among those that follow it."""
    if cuts is None:
        return df.withColumns({name: F.lit(0) for name in places})

    def up_to(place: str) -> Column:
        below = lambda cut: cut <= F.col(place)
        block = F.size(F.filter("_heads", below))
        return F.when(block > 0, (block - 1) * F.col("_step") + F.size(F.filter(F.get("_blocks", block - 1), below))).otherwise(0)

    joined = df.join(F.broadcast(cuts), list(keys), "left")
    return joined.withColumns({name: F.when(F.col("_step").isNull(), 0).otherwise(up_to(place)).cast("int") for name, place in places.items()}).drop("_step", "_heads", "_blocks")


def _look_up(group: Sequence[str]):
    """Over rows in the order of their group, a group's points (_first is null) by place before its ranges: each range with its figures.

    No more is kept than the unlike places of one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at, upto = None, np.empty(0, "int64"), np.zeros(1, "int64")
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [batch.column(k) for k in group]
            new = np.zeros(batch.num_rows, bool)
            new[0] = before != [c[0].as_py() for c in columns]
            for c in columns:
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            before = [c[-1].as_py() for c in columns]
            point = batch.column("_first").is_null().to_numpy(zero_copy_only=False)
            place, n, first, last = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("_at", "_n", "_first", "_last"))
            held, least, most = (np.zeros(batch.num_rows, "int64") for _ in range(3))
            starts = np.flatnonzero(new | np.r_[True, point[1:] != point[:-1]])
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                if new[a]:
                    at, upto = at[:0], upto[:1]
                if point[a]:
                    at, upto = np.r_[at, place[a:b]], np.r_[upto, upto[-1] + np.cumsum(n[a:b])]
                elif len(at):
                    i, j = np.searchsorted(at, first[a:b], "left"), np.searchsorted(at, last[a:b], "right")
                    held[a:b], least[a:b], most[a:b] = upto[j] - upto[i], at[np.minimum(i, len(at) - 1)], at[j - 1]
            none = held == 0
            out = {"_row": batch.column("_row"), "_held": pa.array(held), "_least": pa.array(least, mask=none), "_most": pa.array(most, mask=none)}
            yield pa.RecordBatch.from_pydict(out).filter(pa.array(~point))

    return run


def _looked_up(points: DataFrame, ranges: DataFrame, keys: Sequence[str], heavy: int) -> DataFrame:
    """_row of each range with _held, _least and _most of the points of its own bin.

    Ranges that crowd a bin are dealt to parts, each of which has the bin's points; crowded is where many of each `heavy`-th range stand.
    """
    mix = F.xxhash64(*keys, "_first", "_last")
    crowded = F.broadcast(ranges.where(F.pmod(mix, F.lit(heavy)) == 0).groupBy(*keys, "_bin").agg(F.count("*").cast("int").alias("_parts")).where("_parts > 1"))
    parts = F.coalesce("_parts", F.lit(1))
    p = points.join(crowded, [*keys, "_bin"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    r = ranges.join(crowded, [*keys, "_bin"], "left").withColumn("_part", F.pmod(F.xxhash64(mix), parts).cast("int"))
    group = [*keys, "_bin", "_part"]
    both = p.select(*group, "_at", "_n").unionByName(r.select(*group, "_first", "_last", "_row"), allowMissingColumns=True)
    ordered = both.repartition(*group).sortWithinPartitions(*group, F.col("_first").asc_nulls_first(), "_at")
    return ordered.mapInArrow(_look_up(group), f"_row {ranges.schema['_row'].dataType.simpleString()}, _held bigint, _least bigint, _most bigint")


def range_contents(ranges: DataFrame, first: str, last: str, rows: DataFrame, at: str, keys: Sequence[str] = (), heavy: int = HEAVY) -> DataFrame:
    """ranges with rows_in_range, least and most of the rows that stand in each, however ranges overlap; no pair of both is made.

    A key's places are cut into bins before one place in `heavy`, taken by its hash, so most keys have one bin. A range within
    one bin meets its points by key; one that reaches farther meets those of its first and its last bin, and the bins between
    count as a whole. Places and bounds are whole numbers; a null place, bound or key, and a range that ends before it begins, meet nothing.
    """
    own = [*keys, first, last]
    there = rows
    for c in [*keys, at]:
        there = there.where(F.col(c).isNotNull())
    names, points = _keyed(there, keys, _at=F.col(at).cast("bigint"))
    cut = points.where(F.pmod(F.xxhash64(*names, "_at"), F.lit(heavy)) == 0).groupBy(*names).agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))
    cuts = None
    if not cut.isEmpty():
        stepped = cut.withColumn("_step", F.ceil(F.sqrt(F.size("_cuts"))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(1), F.size("_cuts"), F.col("_step")), lambda i: F.slice("_cuts", i, F.col("_step")))
        cuts = stepped.select(*names, "_step", blocks.alias("_blocks")).withColumn("_heads", F.transform("_blocks", lambda b: b[0]))
    points = _with_bin(points.groupBy(*names, "_at").agg(F.count("*").alias("_n")), names, cuts, _bin="_at")
    good = F.coalesce(F.col(first) <= F.col(last), F.lit(False))
    for k in keys:
        good = good & F.col(k).isNotNull()
    rest = [c for c in ranges.columns if c not in own]
    kind = rows.schema[at].dataType
    figures = [F.col("_held").alias("rows_in_range"), F.col("_least").cast(kind).alias("least"), F.col("_most").cast(kind).alias("most")]
    without = ranges.where(~good).select(*own, *rest, F.lit(0).cast("bigint").alias("rows_in_range"), F.lit(None).cast(kind).alias("least"), F.lit(None).cast(kind).alias("most"))
    placed = _keyed(ranges.where(good), keys, _first=F.col(first).cast("bigint"), _last=F.col(last).cast("bigint"), _row=F.struct(*own, *rest))[1]
    placed = _with_bin(placed, names, cuts, _bin="_first", _end="_last")
    out = _looked_up(points, placed.where("_bin = _end"), names, heavy).select("_row.*", *figures).unionByName(without)
    if cuts is None:
        return out
    far = placed.where("_bin < _end")
    once = far.select(*names, "_first", "_last", "_bin", "_end").distinct()
    ends = once.withColumn("_row", F.struct(*names, "_first", "_last")).withColumn("_bin", F.explode(F.array("_bin", "_end")))
    outer = _looked_up(points, ends.drop("_end"), names, heavy).select("_row.*", "_held", "_least", "_most")
    # Every bin but a key's first has its cut in it, so those between are neighbours in number; a row for each bin.
    bins = points.join(F.broadcast(cut), names, "left_semi").groupBy(*names, "_bin").agg(F.sum("_n").alias("_n"), F.min("_at").alias("_min"), F.max("_at").alias("_max"))
    bins = bins.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*names).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)))
    after = bins.select(*names, (F.col("_bin") - 1).alias("_bin"), (F.col("_upto") - F.col("_n")).alias("_below"), F.col("_min").alias("_least"))
    until = bins.select(*names, (F.col("_bin") + 1).alias("_end"), "_upto", F.col("_max").alias("_most"))
    between = once.where("_end - _bin > 1").join(F.broadcast(after), [*names, "_bin"]).join(F.broadcast(until), [*names, "_end"])
    inner = between.select(*names, "_first", "_last", (F.col("_upto") - F.col("_below")).alias("_held"), "_least", "_most")
    sums = outer.unionByName(inner).groupBy(*names, "_first", "_last").agg(F.sum("_held").alias("_held"), F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    return out.unionByName(far.join(sums, [*names, "_first", "_last"]).select("_row.*", *figures))
