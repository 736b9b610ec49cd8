"""Reports over executions, steps and errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import elapsed_millis
from ..schema import COUNTERS


def latest_replayable(errors: DataFrame, executions: DataFrame, modes: Sequence[str] = ("BACKFILL",), statuses: Sequence[str] = ("COMPLETED_WITH_ERRORS",)) -> DataFrame:
    """The execution with the latest finish that has open errors, and how many; one row or none."""
    opened = errors.where("status = 'OPEN'").groupBy("execution_id").agg(F.count("*").alias("open_errors"))
    fit = executions.where(F.col("mode").isin(*modes) & F.col("status").isin(*statuses) & F.col("finished_at").isNotNull())
    return fit.join(opened, "execution_id").orderBy(F.desc("finished_at"), F.desc("execution_id")).limit(1).select("execution_id", "finished_at", "open_errors")


def preflight(open_errors: Column, replayable: Column) -> Column:
    """What to run next."""
    return F.when((open_errors > 0) & replayable, "OPEN_ERRORS_REQUIRE_REPLAY").when(open_errors > 0, "OPERATOR_REVIEW").otherwise("RUN")


def bucketed(value: Column, known: Sequence[str]) -> Column:
    return F.when(value.isin(*known), value).otherwise("OTHER")


def error_groups(errors: DataFrame, types: Sequence[str], codes: Sequence[str], key: str = "execution_id") -> DataFrame:
    """Per key the errors by known type and code, as one ordered JSON array and one text."""
    counted = errors.groupBy(key, bucketed(F.col("error_type"), types).alias("type"), bucketed(F.col("error_code"), codes).alias("code")).agg(F.count("*").alias("count"))
    rows = F.array_sort(F.collect_list(F.struct("type", "code", "count")))  # a few known values for each key
    text = F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["type"], r["code"], r["count"].cast("string"))), ",")
    return counted.groupBy(key).agg(F.to_json(rows).alias("groups_json"), text.alias("groups_text"))


def step_durations(steps: DataFrame, names: Sequence[str], key: str = "execution_id") -> DataFrame:
    """Milliseconds of each named step, one row for each execution."""
    ms = elapsed_millis(F.col("started_at"), F.col("ended_at"))
    return steps.groupBy(key).agg(*[F.max(F.when(F.col("step") == n, ms)).alias(f"{n}_ms") for n in names])


def remaining(errors: DataFrame, bound: int) -> DataFrame:
    """Open and resolved errors up to a bound; null over none."""
    return errors.where(F.col("error_key") <= bound).groupBy("execution_id").agg(F.sum((F.col("status") == "OPEN").cast("bigint")).alias("open_count"), F.sum((F.col("status") == "RESOLVED").cast("bigint")).alias("resolved_count"))


def cooldown(runs: DataFrame, now: Column, seconds: int = 300) -> DataFrame:
    """Seconds until the next run may start, after the newest terminal one."""
    return runs.agg(F.max("ended_at").alias("last_end")).select("last_end", F.greatest(F.lit(0), F.lit(seconds) - F.floor((F.unix_micros(now) - F.unix_micros("last_end")) / 1_000_000)).cast("bigint").alias("wait_seconds"))


def ordered_digest(rows: DataFrame, keys: Sequence[str], order: str, value: Column) -> DataFrame:
    """SHA-256 of each key's values in order. A key's values meet in one task: for groups of bounded size."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
    return rows.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(pairs, lambda p: p["v"]), "|"), 256).alias("digest"))


def row_hash(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row's values as text, each with its length; a null differs from any text, wherever it stands."""
    value = lambda c: F.col(c).cast("string")
    parts = [F.coalesce(F.concat(F.length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def table_digest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A digest of a whole table that doesn't depend on order: count, xor and sum of row hashes. Scales as any sum."""
    h = row_hash(columns)
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor_hash"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"))


def paired_digest(staging: DataFrame, target: DataFrame, execution_id: str | None = None) -> DataFrame:
    """One digest of staged rows joined with the target by doi: keys, both hashes and times. Rows without a target count too."""
    own = staging if execution_id is None else staging.where(F.col("execution_id") == execution_id)
    there = target.select("doi", F.col("content_hash").alias("target_hash"), F.col("source_indexed_at").alias("target_at"))
    return table_digest(own.join(there, "doi", "left"), ["staging_key", "doi", "content_hash", "target_hash", "target_at"])


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether two digests, one row each, are the same."""
    a = before.select(F.lit(1).alias("_k"), F.struct(*before.columns).alias("a"))
    return a.join(after.select(F.lit(1).alias("_k"), F.struct(*before.columns).alias("b")), "_k").select(F.col("a").eqNullSafe(F.col("b")).alias("unchanged"))


def replay_source(errors: DataFrame, staging: DataFrame, executions: DataFrame, modes: Sequence[str] = ("BACKFILL",), statuses: Sequence[str] = ("COMPLETED_WITH_ERRORS",)) -> DataFrame:
    """Open errors with a staged row, by finished execution that a replay may take them from: the greatest key, and how many."""
    fit = executions.where(F.col("mode").isin(*modes) & F.col("status").isin(*statuses) & F.col("finished_at").isNotNull())
    opened = errors.where("status = 'OPEN'").select("execution_id", "staging_key", "error_key")
    there = opened.join(staging.select("execution_id", "staging_key"), ["execution_id", "staging_key"])
    return there.join(fit.select("execution_id", "started_at"), "execution_id").groupBy("execution_id", "started_at").agg(F.max("error_key").alias("error_bound"), F.count("*").alias("selected"))


def preflight_report(errors: DataFrame, staging: DataFrame, executions: DataFrame, mode: str) -> DataFrame:
    """One row: what a run of that mode may do, the errors behind it, the execution to replay, and the mode to run next."""
    source = replay_source(errors, staging, executions)
    newest = source.agg(F.coalesce(F.sum("selected"), F.lit(0)).cast("bigint").alias("replayable_errors"), F.max(F.struct("started_at", "execution_id", "error_bound", "selected")).alias("s"))
    total = errors.agg(F.count_if(F.col("status") == "OPEN").alias("open_errors"))
    both = total.withColumn("_k", F.lit(1)).join(newest.withColumn("_k", F.lit(1)), "_k")
    none, waiting = F.col("s").isNull(), F.col("open_errors") > 0
    if mode == "BACKFILL":
        decision = F.when(waiting & none, "OPERATOR_REVIEW").when(waiting, "OPEN_ERRORS_REQUIRE_REPLAY")
    elif mode == "REPLAY_ERRORS":
        decision = F.when(none & waiting, "OPERATOR_REVIEW").when(none, "NO_REPLAY_TARGET")
    else:
        decision = F.lit(None).cast("string")
    decision = F.coalesce(decision, F.lit("RUN"))
    after = F.when(decision == "OPEN_ERRORS_REQUIRE_REPLAY", "REPLAY_ERRORS").when(decision == "OPERATOR_REVIEW", "OPERATOR_REVIEW").when(decision == "NO_REPLAY_TARGET", "BACKFILL").otherwise(mode)
    return both.select("open_errors", "replayable_errors", F.col("s.execution_id").alias("source_execution_id"), F.coalesce("s.error_bound", F.lit(0)).alias("error_bound"), F.coalesce("s.selected", F.lit(0)).alias("selected"), decision.alias("decision"), after.alias("next_mode"))


def run_summary(executions: DataFrame, staging: DataFrame, chunks: DataFrame, errors: DataFrame, steps: DataFrame | None = None, names: Sequence[str] = ("collect", "sync")) -> DataFrame:
    """A row for each execution: what was expected, staged and accounted for, by outcome, its errors, its pages, its steps' times.

    executions(execution_id, mode, status, expected_count, pages); steps(execution_id, step, started_at, ended_at). An
    execution without chunks, errors or steps has zeros, and null times.
    """
    staged = staging.groupBy("execution_id").agg(F.count("*").alias("staged"))
    totals = chunks.groupBy("execution_id").agg(*[F.sum(c).alias(c) for c in COUNTERS], F.sum(sum((F.col(c) for c in COUNTERS[1:]), F.col(COUNTERS[0]))).alias("accounted"))
    found = errors.groupBy("execution_id").agg(F.count_if(F.col("status") == "OPEN").alias("open_errors"), F.count_if(F.col("status") == "RESOLVED").alias("resolved_errors"))
    out = executions
    for part in (staged, totals, found):
        out = out.join(part, "execution_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("staged", *COUNTERS, "accounted", "open_errors", "resolved_errors")})
    return out if steps is None else out.join(step_durations(steps, names), "execution_id", "left")


def summary_faults(summary: DataFrame, expected: int | Column, pages: int | Column) -> DataFrame:
    """What contradicts a published success, by execution; an empty list where nothing does.

    A backfill must have staged and accounted for as many rows as expected, from so many pages, and leave no error open; a
    replay (with the columns source_open, source_resolved and selected) must have drained its source.
    """
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    replay, backfill = F.col("mode") == "REPLAY_ERRORS", F.col("mode") == "BACKFILL"
    rules = [(F.col("status") != "COMPLETED", "status"), (backfill & (F.col("expected_count") != lit(expected)), "expected"), (backfill & (F.col("staged") != lit(expected)), "staged"), (backfill & (F.col("accounted") != lit(expected)), "accounted")]
    rules += [(backfill & (F.col("pages") != lit(pages)), "pages"), (backfill & (F.col("open_errors") > 0), "open errors")]
    if "source_open" in summary.columns:
        rules += [(replay & (F.col("source_open") > 0), "source not drained"), (replay & (F.col("source_resolved") < F.col("selected")), "source not resolved")]
    return summary.select("execution_id", F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for bad, name in rules])).alias("faults"))


def replay_report(errors: DataFrame, staging: DataFrame, chunks: DataFrame, target: DataFrame, executions: DataFrame, replays: DataFrame) -> DataFrame:
    """What replays(execution_id, source_error_key) have made of each source error: its state, and the replay's own rows.

    Whether the replay's row has come to the target is told by its doi; `proven` says that nothing contradicts a success.
    """
    rows = staging.join(replays, ["execution_id", "source_error_key"]).select("execution_id", "source_error_key", "doi")
    mine = lambda df, *more: df.join(replays.select("execution_id").distinct(), "execution_id", "left_semi").groupBy("execution_id").agg(*more)
    source = errors.select(F.col("error_key").alias("source_error_key"), F.col("status").alias("error_status"), "replay_count")
    out = rows.join(source, "source_error_key").join(executions.select("execution_id", F.col("status").alias("replay_status")), "execution_id")
    for part in (mine(errors, F.count("*").alias("new_errors")), mine(staging, F.count("*").alias("staged")), mine(chunks, F.sum("inserted_count").alias("inserted"))):
        out = out.join(part, "execution_id", "left")
    out = out.join(target.select("doi", F.lit(1).alias("target_rows")), "doi", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("new_errors", "staged", "inserted", "target_rows")})
    proven = (F.col("error_status") == "RESOLVED") & (F.col("replay_status") == "COMPLETED") & (F.col("new_errors") == 0) & (F.col("target_rows") == 1)
    return out.select("execution_id", "source_error_key", "error_status", "replay_count", "new_errors", "staged", "inserted", "target_rows", "replay_status", proven.alias("proven"))


def execution_steps(executions: DataFrame, steps: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every execution with its steps' milliseconds; null where it has no such step."""
    return executions.join(step_durations(steps, names), "execution_id", "left")


def latest_completed(executions: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Of each request's completed executions the one with the greatest id."""
    return executions.where(F.col("status").isin("COMPLETED", "COMPLETED_WITH_ERRORS")).groupBy(*keys).agg(F.max("execution_id").alias("execution_id"), F.max_by("status", "execution_id").alias("status"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of several tables: name and n, and their sum under the name `total`."""
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    every = each[0]
    for one in each[1:]:
        every = every.unionByName(one)
    return every.unionByName(every.agg(F.sum("n").alias("n")).select(F.lit("total").alias("name"), "n"))


def rolled_up(steps: DataFrame, keys: Sequence[str], counters: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Per key how many steps there are, the sums of their counters, and whether any step fits each flag."""
    return steps.groupBy(*keys).agg(F.count("*").alias("steps"), *[F.sum(c).alias(c) for c in counters], *[F.bool_or(c).alias(name) for name, c in flags.items()])


def sample_trend(samples: DataFrame, keys: Sequence[str], order: str, value: str, tail: int = 64, ends: int = 16) -> DataFrame:
    """Whether the floor of the last samples rises: least of the first and of the last `ends` of the last `tail`.

    A plateau has `tail` samples and grows by no more than the larger of 8 MiB and a tenth.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    last = samples.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= tail)
    out = last.groupBy(*keys).agg(F.count("*").alias("samples"), F.max(value).alias("peak"), F.min(F.when(F.col("_n") > tail - ends, F.col(value))).alias("first_floor"), F.min(F.when(F.col("_n") <= ends, F.col(value))).alias("last_floor"))
    return out.withColumn("plateau", (F.col("samples") == tail) & (F.col("last_floor") - F.col("first_floor") <= F.greatest(F.lit(8 * 1024 * 1024), F.col("first_floor") / 10)))


def owner_sums(attempts: DataFrame, owner: str, columns: Sequence[str]) -> DataFrame:
    """Sums over attempts, each owner counted once."""
    return attempts.dropDuplicates([owner]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
