"""Latest-wins synchronisation with the target kept as state by doi: a micro-batch touches the state of its own dois alone.

Each batch is a chunk, as in sync_stream, and its decisions are the same; but what the target holds is the stream's own
keyed state, in place of a table that is read and written for each batch. A doi's rows of one batch pass once, with
a few values kept of them, whatever their number. The state store must hold more than memory does: RocksDB.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..schema import struct

STATE = "latest_us bigint, content_hash string, content_key bigint"
DECISIONS = struct("doi string, decision string, n bigint, ties bigint, older bigint, winner_key bigint, latest_us bigint, content_hash string, kept_us bigint, kept_hash string")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class LatestWins(StatefulProcessor):
    """Decides on a doi's rows of one batch against what is kept of it, and keeps what they leave."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, ties, latest, least, most, winner = 0, 0, None, None, None, None
        for part in rows:
            n += len(part)
            top = int(part["indexed_us"].max())
            if latest is not None and top < latest:
                continue
            at = part[part["indexed_us"] == top]
            low, high, first = at["content_hash"].min(), at["content_hash"].max(), int(at["staging_key"].min())
            if latest is None or top > latest:
                ties, latest, least, most, winner = len(at), top, low, high, first
            else:
                ties, least, most, winner = ties + len(at), min(least, low), max(most, high), min(winner, first)
        was = self.kept.get() if self.kept.exists() else None
        if least != most:
            decision = "GROUP_CONFLICT"
        elif was is None:
            decision = "INSERTED"
        elif latest < was[0]:
            decision = "SUPERSEDED"
        elif latest == was[0]:
            decision = "NO_OP" if least == was[1] else "CONFLICT"
        else:
            decision = "INDEX_ADVANCED" if least == was[1] else "UPDATED"
        if decision in ("INSERTED", "UPDATED"):
            was = (latest, least, winner)
        elif decision == "INDEX_ADVANCED":
            was = (latest, was[1], was[2])
        if decision in ("INSERTED", "UPDATED", "INDEX_ADVANCED"):
            self.kept.update(was)
        kept_us, kept_hash = (was[0], was[1]) if was is not None else (None, None)
        yield pd.DataFrame({"doi": [key[0]], "decision": [decision], "n": [n], "ties": [ties], "older": [n - ties], "winner_key": [winner], "latest_us": [latest], "content_hash": [least], "kept_us": pd.array([kept_us], "Int64"), "kept_hash": [kept_hash]})

    def close(self) -> None:
        pass


def decisions(source: DataFrame, shape: StructType = DECISIONS) -> DataFrame:
    """A row for each doi of each batch of source(doi, indexed_at, content_hash, staging_key), with the decision and what the target is left with.

    Rows need a doi, a time and a hash. latest_us and kept_us are microseconds of the epoch. Late rows are superseded, not
    dropped, however late they are.
    """
    rows = source.selectExpr("doi", "unix_micros(cast(indexed_at as timestamp)) indexed_us", "content_hash", "staging_key")
    return rows.groupBy("doi").transformWithStateInPandas(LatestWins(), shape, "Update", "None")
