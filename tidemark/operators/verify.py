"""Reconciliation of an execution against what it left: coverage, accounting, missing targets, winners, one verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import COUNTERS


def accounted() -> Column:
    return sum((F.col(c) for c in COUNTERS[1:]), F.col(COUNTERS[0]))


def _placed(chunks: DataFrame, staging: DataFrame) -> DataFrame:
    """Starts of chunks (row 0) and keys of staged rows (row 1), range-partitioned together and in order."""
    both = F.struct("first_staging_key", "last_staging_key")
    starts = chunks.select("execution_id", F.col("first_staging_key").alias("k"), F.lit(0).alias("row"), both.alias("_start"))
    rows = staging.select("execution_id", F.col("staging_key").alias("k"), F.lit(1).alias("row"), F.lit(None).cast("struct<first_staging_key:bigint,last_staging_key:bigint>").alias("_start"))
    ranged = starts.unionByName(rows).repartitionByRange("execution_id", "k", "row").sortWithinPartitions("execution_id", "k", "row")
    return ranged.withColumn("_part", F.spark_partition_id())


def _chunk_of_rows(placed: DataFrame) -> DataFrame:
    """Each staged row's key with the range of the chunk that starts last at or before it, without gathering an execution's keys.

    A partition's first rows take the last start of the partitions before.
    """
    last = placed.where("row = 0").groupBy("execution_id", "_part").agg(F.max_by("_start", "k").alias("_end"))
    ends = placed.select("execution_id", "_part").distinct().join(last, ["execution_id", "_part"], "left")  # a row or two for each partition
    earlier = Window.partitionBy("execution_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("execution_id", "_part", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    here = Window.partitionBy("execution_id", "_part").orderBy("k", "row").rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumn("_own", F.last("_start", ignorenulls=True).over(here)).where("row = 1")
    return within.join(carried, ["execution_id", "_part"]).select("execution_id", "k", F.coalesce("_own", "_carried").alias("_c"))


def coverage(chunks: DataFrame, staging: DataFrame, settle=lambda df: df) -> DataFrame:
    """Each chunk result of each execution with what is wrong with it, in the order of checking, or null.

    Sequences must be dense from 1; ranges must ascend without overlap inside the execution's bound; a range must hold as
    many staged rows as its counters account for, from its first key to its last. A staged row belongs to the chunk with
    the greatest first key not above its own, which is carried along the keys in place of a range join. settle is applied
    to the rows once they are in order (a checkpoint on a cluster).
    """
    w = Window.partitionBy("execution_id").orderBy("chunk_sequence")
    checked = chunks.withColumn("n", accounted()).withColumn("_last", F.lag("last_staging_key", 1, 0).over(w)).withColumn("_sequence", F.lag("chunk_sequence", 1, 0).over(w))
    placed = settle(_placed(chunks, staging))
    bounds = placed.where("row = 1").groupBy("execution_id").agg(F.max("k").alias("_bound"))
    held = _chunk_of_rows(placed)
    held = held.where("k <= _c.last_staging_key").groupBy("execution_id", F.col("_c.first_staging_key").alias("first_staging_key")).agg(F.count("*").alias("rows_in_range"), F.min("k").alias("_min"), F.max("k").alias("_max"))
    wrong = (
        F.when(F.col("chunk_sequence") != F.col("_sequence") + 1, "gap")
        .when((F.col("first_staging_key") > F.col("last_staging_key")) | (F.col("last_staging_key") > F.coalesce("_bound", F.lit(0))) | (F.col("first_staging_key") <= F.col("_last")), "order")
        .when((F.coalesce("rows_in_range", F.lit(0)) != F.col("n")) | ~F.col("_min").eqNullSafe(F.col("first_staging_key")) | ~F.col("_max").eqNullSafe(F.col("last_staging_key")), "content")
    )
    joined = checked.join(bounds, "execution_id", "left").join(held, ["execution_id", "first_staging_key"], "left")
    return joined.select("execution_id", "chunk_sequence", "first_staging_key", "last_staging_key", F.col("n").alias("accounted"), F.coalesce("rows_in_range", F.lit(0)).cast("bigint").alias("rows_in_range"), wrong.alias("violation"))


def first_failure(checked: DataFrame) -> DataFrame:
    """Per execution the first chunk in violation, and the rows accounted for before it."""
    bad = checked.where("violation is not null").groupBy("execution_id").agg(F.min(F.struct("chunk_sequence", "violation")).alias("b"))
    before = checked.join(bad, "execution_id").where(F.col("chunk_sequence") < F.col("b.chunk_sequence")).groupBy("execution_id").agg(F.sum("accounted").alias("s"))
    return bad.join(before, "execution_id", "left").select("execution_id", F.col("b.chunk_sequence").alias("failed_chunk"), F.col("b.violation").alias("violation"), F.coalesce("s", F.lit(0)).cast("bigint").alias("accounted_before"))


def outcome_totals(chunks: DataFrame) -> DataFrame:
    """One row of sums, zero over no chunks."""
    return chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS], F.coalesce(F.sum(accounted()), F.lit(0)).cast("bigint").alias("accounted"))


def eligible(staging: DataFrame) -> DataFrame:
    """Rows, distinct dois and duplicates of each execution."""
    return staging.groupBy("execution_id").agg(F.count("*").alias("eligible"), F.count_distinct("doi").alias("distinct_dois")).withColumn("duplicates", F.col("eligible") - F.col("distinct_dois"))


def open_errors_by_type(errors: DataFrame) -> DataFrame:
    return errors.where("status = 'OPEN'").groupBy("execution_id", "error_type").agg(F.count("*").alias("n"))


def missing_targets(staging: DataFrame, errors: DataFrame, target: DataFrame) -> DataFrame:
    """Per execution the dois that neither an open error nor the target has."""
    left = staging.join(errors.where("status = 'OPEN'").select("execution_id", "staging_key"), ["execution_id", "staging_key"], "left_anti")
    return left.join(target.select("doi"), "doi", "left_anti").groupBy("execution_id").agg(F.count_distinct("doi").alias("missing"))


def winner_mismatches(staging: DataFrame, errors: DataFrame, target: DataFrame) -> DataFrame:
    """Winners (latest, then least key, of a doi without an open error) that the target is older than or differs from."""
    fine = staging.join(errors.where("status = 'OPEN'").select("execution_id", "staging_key"), ["execution_id", "staging_key"], "left_anti")
    best = fine.groupBy("execution_id", "doi").agg(F.max(F.struct("indexed_at", F.negative("staging_key").alias("k"), "content_hash")).alias("b"))
    best = best.select("execution_id", "doi", F.negative("b.k").alias("staging_key"), F.col("b.indexed_at").alias("indexed_at"), F.col("b.content_hash").alias("wanted"))
    bad = (F.col("source_indexed_at") < F.col("indexed_at")) | ((F.col("source_indexed_at") == F.col("indexed_at")) & (F.col("content_hash") != F.col("wanted")))
    return best.join(target.select("doi", "source_indexed_at", "content_hash"), "doi").where(bad).select("execution_id", "doi", "staging_key")


def row_figures(staging: DataFrame, errors: DataFrame, target: DataFrame) -> DataFrame:
    """Per execution eligible(), rows without a source error, missing (see missing_targets) and mismatches (see winner_mismatches), from one pass over each table."""
    opened = errors.where("status = 'OPEN'").select("execution_id", "staging_key").distinct().withColumn("_open", F.lit(True))
    own = staging.select("execution_id", "staging_key", "doi", "indexed_at", "content_hash", "source_error_key").join(opened, ["execution_id", "staging_key"], "left")
    fine = F.when(F.col("_open").isNull(), F.struct("indexed_at", F.negative("staging_key").alias("k"), F.col("content_hash").alias("wanted")))
    best = own.groupBy("execution_id", "doi").agg(F.count("*").alias("n"), F.count_if(F.col("source_error_key").isNull()).alias("unlinked"), F.max(fine).alias("b"))
    copy = F.row_number().over(Window.partitionBy("doi").orderBy("source_indexed_at"))  # a doi that the target has twice counts once among the rows
    both = best.join(target.select("doi", "source_indexed_at", F.col("content_hash").alias("_held"), copy.alias("_copy")), "doi", "left")
    first = F.coalesce("_copy", F.lit(1)) == 1
    bad = (F.col("source_indexed_at") < F.col("b.indexed_at")) | ((F.col("source_indexed_at") == F.col("b.indexed_at")) & (F.col("_held") != F.col("b.wanted")))
    out = both.groupBy("execution_id").agg(
        F.sum(F.when(first, F.col("n"))).alias("eligible"), F.count_if(first & F.col("doi").isNotNull()).alias("distinct_dois"), F.sum(F.when(first, F.col("unlinked"))).alias("unlinked"),
        F.count_if(F.col("b").isNotNull() & F.col("_copy").isNull()).alias("missing"), F.count_if(F.col("_copy").isNotNull() & bad).alias("mismatches"),
    )
    return out.withColumn("duplicates", F.col("eligible") - F.col("distinct_dois"))


def verdicts(staging: DataFrame, chunks: DataFrame, errors: DataFrame, target: DataFrame, expected: DataFrame, replay: bool = False, settle=lambda df: df) -> DataFrame:
    """One row for each execution of expected(execution_id, expected_count): status, reason and the figures behind.

    The first check that fails names the reason: coverage, lineage of replayed rows, counts, types of open errors, errors
    against counters, missing targets, winners; then conflicts. Validation errors alone end as COMPLETED_WITH_ERRORS.
    """
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    totals = chunks.groupBy("execution_id").agg(F.sum(accounted()).alias("accounted"), F.sum("conflict_count").alias("conflicts"), F.sum("validation_error_count").alias("validations"))
    failures = first_failure(coverage(chunks, staging, settle)).select("execution_id", "violation")
    opened = errors.where("status = 'OPEN'").groupBy("execution_id").agg(
        F.count_if(F.col("error_type") == "CONFLICT").alias("open_conflicts"), F.count_if(F.col("error_type") == "VALIDATION").alias("open_validations"), F.count_if(~F.col("error_type").isin("CONFLICT", "VALIDATION")).alias("open_others")
    )
    out = expected
    for part in (totals, failures, opened, row_figures(staging, errors, target)):
        out = out.join(part, "execution_id", "left")
    figures = ["eligible", "distinct_dois", "duplicates", "accounted", "conflicts", "validations", "open_conflicts", "open_validations", "open_others", "missing", "mismatches"]
    out = out.withColumns({c: zero(F.col(c)) for c in [*figures, "unlinked"]})
    reason = (
        F.when(F.col("violation").isNotNull() | ((F.col("eligible") > 0) & (F.col("accounted") == 0)), "chunk coverage")
        .when(F.lit(replay) & (F.col("unlinked") > 0), "lineage")
        .when((F.col("expected_count") != F.col("eligible")) | (F.col("eligible") != F.col("accounted")), "counts")
        .when(F.col("open_others") > 0, "error types")
        .when((F.col("conflicts") != F.col("open_conflicts")) | (F.col("validations") != F.col("open_validations")), "error counts")
        .when(F.col("missing") > 0, "missing targets")
        .when(F.col("mismatches") > 0, "winner checksum")
        .when(F.col("conflicts") > 0, "conflicts")
    )
    status = F.when(reason.isNotNull(), "FAILED").when(F.col("validations") > 0, "COMPLETED_WITH_ERRORS").otherwise("COMPLETED")
    return out.select("execution_id", status.alias("status"), reason.alias("reason"), *figures)
