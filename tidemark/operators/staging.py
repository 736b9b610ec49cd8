"""Dense sequences, idempotent append, the frozen bound, and range scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_sequence(df: DataFrame, order: Sequence[str], name: str = "execution_sequence", start: int = 0, settle=lambda df: df) -> DataFrame:
    """Numbers rows from start + 1 in a total order, without gaps and without gathering them in one task.

    Rows are range-partitioned and sorted; a partition's numbers begin after the counts of those before it. settle is
    applied to the sorted rows, so that counting and numbering see the same ones (a checkpoint on a cluster).
    """
    sorted_rows = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = sorted_rows.groupBy(part.alias("_part")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))  # a row for each partition
    numbered = sorted_rows.withColumn("_part", part).join(offsets, "_part")
    return numbered.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + start).drop("_part", "_id", "_before")


def prefix_counts(windows: DataFrame, order: str, count: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds collected_before: what earlier windows of the same keys hold. windows has one row a window."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return windows.withColumn("collected_before", F.coalesce(F.sum(count).over(w), F.lit(0)))


def append_missing(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of new whose keys aren't there yet; writing them twice changes nothing.

    Of rows with one key, the one with the least hash of its other columns is taken, whatever their order.
    """
    keys, rest = list(keys), [c for c in new.columns if c not in keys]
    once = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("_row")).select(*keys, "_row.*") if rest else new.distinct()
    return once.join(existing.select(*keys), keys, "left_anti").select(new.columns)


def frozen(staging: DataFrame, keys: Sequence[str] = ("execution_id",)) -> DataFrame:
    """Expected count and upper bound of each execution."""
    return staging.groupBy(*keys).agg(F.count("*").alias("expected_count"), F.coalesce(F.max("staging_key"), F.lit(0)).alias("upper_bound"))


def in_range(staging: DataFrame, execution_id: str | Column, after: int, bound: int) -> DataFrame:
    """Rows of one execution with after < staging_key <= bound."""
    return staging.where((F.col("execution_id") == execution_id) & (F.col("staging_key") > after) & (F.col("staging_key") <= bound))


def page(staging: DataFrame, execution_id: str, after: int, bound: int, size: int) -> DataFrame:
    """The next page of a keyset scan."""
    return in_range(staging, execution_id, after, bound).orderBy("staging_key").limit(size)
