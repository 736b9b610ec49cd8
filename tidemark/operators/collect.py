"""Checks over the log of collected pages, as windows and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PAGE_SIZE
from .staging import dense_sequence


def page_bound(remaining: Column, total: Column, size: int = PAGE_SIZE) -> Column:
    """Pages that a window can have: as many as the remaining limit needs, or one more than all full pages."""
    return F.when(remaining <= total, F.ceil(remaining / size)).otherwise(F.floor(total / size) + 1).cast("bigint")


def repeated_pages(pages: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Each page(window_id, page_no, page_hash, items) with how many full pages before it, in a row, were the same."""
    w = Window.partitionBy("window_id").orderBy("page_no")
    same = pages.withColumn("repeated", F.coalesce((F.col("items") == size) & (F.col("page_hash") == F.lag("page_hash").over(w)), F.lit(False)))
    run = same.withColumn("_run", F.sum((~F.col("repeated")).cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy("window_id", "_run").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)
    return run.withColumn("run_length", F.sum(F.col("repeated").cast("bigint")).over(in_run)).drop("_run")


def idle_runs(pages: DataFrame, limit: int) -> DataFrame:
    """Each page(window_id, page_no, new_rows) with how many pages in a row up to it brought nothing, and if that is too many."""
    w = Window.partitionBy("window_id").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)
    run = pages.withColumn("_run", F.sum((F.col("new_rows") > 0).cast("bigint")).over(w))
    in_run = Window.partitionBy("window_id", "_run").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)
    idle = F.sum((F.col("new_rows") == 0).cast("bigint")).over(in_run)
    return run.withColumn("idle_pages", idle).withColumn("failed", F.col("idle_pages") >= limit).drop("_run")


def window_evidence(pages: DataFrame) -> DataFrame:
    """Per window: the first page's total, pages, rows and new rows."""
    return pages.groupBy("window_id").agg(F.min_by("total_results", "page_no").alias("reported_total"), F.count("*").alias("pages"), F.sum("items").alias("rows"), F.sum("new_rows").alias("new_rows"))


def reported_total(pages: DataFrame) -> DataFrame:
    """One row: what the windows' first pages report together, and how many windows, pages and rows there are; zeros over none."""
    each = window_evidence(pages)
    return each.agg(F.count("*").alias("windows"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("reported_total", "pages", "rows", "new_rows")])


def progress(known: DataFrame, pages: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """known(window_id, pages, rows, status) brought on by a log of pages; counts never fall, and a short last page ends a window."""
    now = pages.groupBy("window_id").agg(F.max("page_no").alias("_page"), F.sum("items").alias("_rows"), F.count("*").alias("_pages"), F.max_by("items", "page_no").alias("_last"))
    both = known.join(now, "window_id", "full_outer")
    most = lambda a, b: F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))).cast("bigint")
    status = F.when((F.col("status") == "COLLECTED") | (F.col("_last") < size), "COLLECTED").when(F.col("_page").isNotNull(), "COLLECTING").otherwise(F.col("status"))
    return both.select("window_id", most(F.col("pages"), F.col("_pages")).alias("pages"), most(F.col("rows"), F.col("_rows")).alias("rows"), status.alias("status"))


def same_in_order(requested: DataFrame, pending: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """One row: whether requested rows are the pending ones, in the same order. Both have a dense number from 0 in `order`."""
    a, b = (df.select(order, F.struct(*keys).alias(name)) for df, name in ((requested, "a"), (pending, "b")))
    return a.join(b, order, "full_outer").agg(F.coalesce(F.bool_and(F.col("a").eqNullSafe(F.col("b"))), F.lit(True)).alias("same"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differences"))


def limited(rows: DataFrame, order: list[str], limit: int, settle) -> DataFrame:
    """The first `limit` rows in a total order, numbered from 1: one limit for all windows of a run, however many tasks read them."""
    return dense_sequence(rows, order, settle=settle).where(F.col("execution_sequence") <= limit)
