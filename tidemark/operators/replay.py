"""Replay of open errors: a snapshot with lineage, resolution afterwards, and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import dense_sequence


def snapshot(errors: DataFrame, staging: DataFrame, source_execution: str | Column, replay_execution: str, settle=lambda df: df) -> DataFrame:
    """The staged rows of a source execution's open errors, in the order of error keys, under the replay's own id.

    A replay numbers its rows densely from 1 and names each one's error; it holds the errors of one execution.
    """
    opened = errors.where((F.col("status") == "OPEN") & (F.col("execution_id") == source_execution)).select("execution_id", "staging_key", "error_key")
    found = opened.join(staging.drop("source_error_key"), ["execution_id", "staging_key"])
    numbered = dense_sequence(found.drop("execution_sequence"), ["error_key"], settle=settle)
    return numbered.withColumn("execution_id", F.lit(replay_execution)).withColumnRenamed("error_key", "source_error_key").drop("staging_key")


def _hits(errors: DataFrame, replayed: DataFrame, source_execution: str | Column | None) -> DataFrame:
    """errors with _hit where replayed(source_error_key) names them, and they are the source execution's if one is given."""
    keys = replayed.select(F.col("source_error_key").alias("error_key")).distinct().withColumn("_hit", F.lit(True))
    own = F.lit(True) if source_execution is None else F.col("execution_id") == source_execution
    return errors.join(keys, "error_key", "left").withColumn("_hit", F.coalesce(F.col("_hit") & own, F.lit(False)))


def counted(errors: DataFrame, replayed: DataFrame, source_execution: str | Column | None = None) -> DataFrame:
    """errors with replay_count one higher where replayed(source_error_key) names them."""
    return _hits(errors, replayed, source_execution).withColumn("replay_count", F.col("replay_count") + F.col("_hit").cast("int")).drop("_hit")


def resolved(errors: DataFrame, replayed: DataFrame, completed: bool, run_ts: Column, source_execution: str | Column | None = None) -> DataFrame:
    """errors with those that a completed replay names, and that are still open, resolved."""
    if not completed:
        return errors
    done = F.col("_hit") & (F.col("status") == "OPEN")
    return _hits(errors, replayed, source_execution).withColumns({"resolved_at": F.when(done, run_ts).otherwise(F.col("resolved_at")), "status": F.when(done, "RESOLVED").otherwise(F.col("status"))}).drop("_hit")


def lineage_violations(staging: DataFrame) -> DataFrame:
    """Source errors that one replay holds more than once; rows without one may repeat."""
    return staging.where("source_error_key is not null").groupBy("execution_id", "source_error_key").agg(F.count("*").alias("n")).where("n > 1")
