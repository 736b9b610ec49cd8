"""UTC day windows, incremental ranges and the high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_plan(ranges: DataFrame, start: str = "range_from", end: str = "range_until") -> DataFrame:
    """Each half-open range, split at midnights, with a dense sequence from 0. An empty or reversed range is an error."""
    checked = ranges.withColumn("_ok", F.assert_true(F.col(start) < F.col(end), "range must increase"))
    first = F.date_trunc("DAY", start).cast("timestamp_ntz")
    days = F.sequence(first, F.col(end) - F.expr("interval 1 microsecond"), F.expr("interval 1 day"))
    out = checked.where("_ok is null").select(*ranges.columns, F.posexplode(days).alias("window_sequence", "_day"))
    return out.select(*ranges.columns, "window_sequence", F.greatest("_day", start).alias("window_from"), F.least(F.col("_day") + F.expr("interval 1 day"), F.col(end)).alias("window_until"))


def pending(windows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return windows.join(done.select(*keys), keys, "left_anti")


def incremental_range(mark: Column, bootstrap: Column, requested: Column, started: Column) -> tuple[Column, Column]:
    """From the mark, or else the bootstrap time; until the requested time, or else the start of the run."""
    return F.coalesce(mark, bootstrap), F.coalesce(requested, started)


def may_advance(mode: Column, reconciled: Column, conflicts: Column, mark: Column, until: Column) -> Column:
    """The mark moves for a wholly reconciled incremental range without conflicts, and never backwards."""
    return (mode == "INCREMENTAL") & reconciled & (conflicts == 0) & (mark.isNull() | (until >= mark))


def advanced(marks: DataFrame, results: DataFrame) -> DataFrame:
    """marks(source_name, mark) after results(source_name, mode, reconciled, conflicts, until): one row a source."""
    moved = results.join(marks, "source_name", "left").where(may_advance(F.col("mode"), F.col("reconciled"), F.col("conflicts"), F.col("mark"), F.col("until")))
    best = moved.groupBy("source_name").agg(F.max("until").alias("_new"))
    return marks.join(best, "source_name", "full_outer").select("source_name", F.coalesce("_new", "mark").alias("mark"))
