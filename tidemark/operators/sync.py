"""Latest-wins synchronisation: one outcome for every staged row, whatever the number of chunks, in one plan.

Staged rows are taken in chunks of consecutive sequence numbers, and a chunk sees the target as the chunks before have
left it. Rows are exchanged by chunk, so that none gathers a doi's rows, and reduced there to one for each doi; a doi
that holds a third of all rows goes on as a row for each chunk. What a chunk finds in the target is the greatest
(time, earlier chunk first) of all groups before it that were not in conflict: a running maximum over the doi's chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CHUNK_SIZE, CONFLICT_CODE, OUTCOMES

_GROUP = ["execution_id", "doi", "chunk"]


def chunk_of(sequence: Column, chunk_size: int = CHUNK_SIZE) -> Column:
    """The chunk of a dense sequence number, both from 1."""
    return (F.floor((sequence - 1) / chunk_size) + 1).cast("bigint")


def groups(staging: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """One row for each execution, doi and chunk: latest time, its rows, digests and least key, and older rows.

    A chunk's rows are brought together, which are as few for every doi, and are sorted once for both levels.
    """
    own = staging.select("execution_id", "doi", "indexed_at", "content_hash", "staging_key", chunk_of(F.col("execution_sequence"), chunk_size).alias("chunk"))
    timed = own.repartition("execution_id", "chunk").groupBy(*_GROUP, "indexed_at").agg(F.count("*").alias("n"), F.min("content_hash").alias("least"), F.max("content_hash").alias("most"), F.min("staging_key").alias("key"))
    best = timed.groupBy(*_GROUP).agg(F.max(F.struct("indexed_at", "n", "least", "most", "key")).alias("b"), F.sum("n").alias("n"))
    return best.select(
        *_GROUP, F.col("b.indexed_at").alias("latest_at"), "n", F.col("b.n").alias("ties"), (F.col("n") - F.col("b.n")).alias("older"),
        (F.col("b.least") != F.col("b.most")).alias("split"), F.col("b.least").alias("content_hash"), F.col("b.key").alias("winner_key"),
    )


def decisions(staging: DataFrame, target: DataFrame | None = None, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """groups with the decision on each: GROUP_CONFLICT, or the winner's outcome.

    target(doi, source_indexed_at, content_hash) is what each execution starts from; executions don't see each other.
    """
    seen = groups(staging, chunk_size)
    columns = seen.columns
    before = Window.partitionBy("execution_id", "doi").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    was = F.max(F.when(~F.col("split"), F.struct("latest_at", F.negative("chunk").alias("rank"), "content_hash"))).over(before)
    if target is not None:
        start = F.struct(F.col("source_indexed_at").alias("latest_at"), F.lit(0).cast("bigint").alias("rank"), "content_hash")
        seen = seen.join(target.groupBy("doi").agg(F.max(start).alias("_start")), "doi", "left")
        was = F.greatest(was, F.col("_start"))
    seen = seen.withColumn("was", was)
    newer, same = F.col("latest_at") > F.col("was.latest_at"), F.col("content_hash") == F.col("was.content_hash")
    decision = (
        F.when(F.col("split"), "GROUP_CONFLICT")
        .when(F.col("was").isNull(), "INSERTED")
        .when(F.col("latest_at") < F.col("was.latest_at"), "SUPERSEDED")
        .when(newer & same, "INDEX_ADVANCED")
        .when(newer, "UPDATED")
        .when(same, "NO_OP")
        .otherwise("CONFLICT")
    )
    return seen.where("chunk > 0").select(*columns, decision.alias("decision"))


def _counts() -> list[Column]:
    d = F.col("decision")
    extra = {"SUPERSEDED": F.when(d != "GROUP_CONFLICT", F.col("older")).otherwise(0), "NO_OP": F.when(d != "GROUP_CONFLICT", F.col("ties") - 1).otherwise(0), "CONFLICT": F.when(d == "GROUP_CONFLICT", F.col("n")).otherwise(0)}
    return [F.sum((d == x).cast("bigint") + extra.get(x, F.lit(0))).cast("bigint").alias(f"{x.lower()}_count") for x in OUTCOMES]


def chunk_results(decided: DataFrame, staging: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Per execution and chunk: first and last key, and how many rows had each outcome."""
    counted = decided.groupBy("execution_id", F.col("chunk").alias("chunk_sequence")).agg(*_counts())
    keys = staging.groupBy("execution_id", chunk_of(F.col("execution_sequence"), chunk_size).alias("chunk_sequence")).agg(F.min("staging_key").alias("first_staging_key"), F.max("staging_key").alias("last_staging_key"))
    return keys.join(counted, ["execution_id", "chunk_sequence"]).withColumn("validation_error_count", F.lit(0).cast("bigint"))


def row_outcomes(decided: DataFrame, staging: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """staging with the outcome of every row."""
    own = decided.select(*_GROUP, "latest_at", "winner_key", "decision")
    rows = staging.withColumn("chunk", chunk_of(F.col("execution_sequence"), chunk_size)).join(own, _GROUP)
    outcome = (
        F.when(F.col("decision") == "GROUP_CONFLICT", "CONFLICT")
        .when(F.col("staging_key") == F.col("winner_key"), F.col("decision"))
        .when(F.col("indexed_at") < F.col("latest_at"), "SUPERSEDED")
        .otherwise("NO_OP")
    )
    return rows.withColumn("outcome", outcome).drop("latest_at", "winner_key", "decision")


def conflict_errors(outcomes: DataFrame) -> DataFrame:
    """An open error for every row in conflict."""
    return outcomes.where("outcome = 'CONFLICT'").select("execution_id", "staging_key", F.lit("CONFLICT").alias("error_type"), F.lit(CONFLICT_CODE).alias("error_code"), F.lit("OPEN").alias("status"), F.lit(0).alias("replay_count"))


def in_conflict(decided: DataFrame) -> DataFrame:
    """The groups that have rows in conflict: row_outcomes() of them alone has all such rows."""
    return decided.where("decision in ('GROUP_CONFLICT', 'CONFLICT')")


def winners(decided: DataFrame) -> DataFrame:
    """The group that the target is left with, one for each execution and doi that changes it, and how it got there.

    first is the group that inserted or last updated the content, key its winner, latest_at the time it ends with.
    """
    moved = decided.where("decision in ('INSERTED', 'UPDATED', 'INDEX_ADVANCED')")
    written = F.when(F.col("decision") != "INDEX_ADVANCED", F.struct("chunk", "winner_key", "content_hash"))
    out = moved.groupBy("execution_id", "doi").agg(F.max("latest_at").alias("latest_at"), F.max(written).alias("w"), F.bool_or(F.col("decision") == "INSERTED").alias("inserted"))
    return out.select("execution_id", "doi", "latest_at", F.col("w.winner_key").alias("content_key"), F.col("w.content_hash").alias("content_hash"), "inserted")


def upserted(target: DataFrame, staging: DataFrame, decided: DataFrame, columns: list[str], run_ts: Column) -> DataFrame:
    """The target after one execution: inserted, wholly updated, advanced in time only, or as it was.

    columns are those that an update replaces. An advance keeps updated_at, an update keeps id and created_at.
    """
    won = winners(decided)
    content = won.where("content_key is not null").select("content_key").join(staging.select(F.col("staging_key").alias("content_key"), *[F.col(c).alias(f"_{c}") for c in columns]), "content_key")
    new = won.select(F.col("doi").alias("_key"), "latest_at", "content_key").join(content, "content_key", "left")
    joined = target.join(new, target["doi"].eqNullSafe(new["_key"]), "full_outer")
    written = F.col("content_key").isNotNull()
    out = {c: F.when(written, F.col(f"_{c}")).otherwise(target[c]) for c in columns if c != "doi"}
    return joined.select(
        F.coalesce(target["id"], F.uuid()).alias("id"), F.coalesce(target["doi"], F.col("_key")).alias("doi"),
        *[out[c].alias(c) for c in columns if c != "doi"],
        F.coalesce("latest_at", "source_indexed_at").alias("source_indexed_at"),
        F.coalesce(target["created_at"], run_ts).alias("created_at"),
        F.when(written, run_ts).otherwise(target["updated_at"]).alias("updated_at"),
    )
