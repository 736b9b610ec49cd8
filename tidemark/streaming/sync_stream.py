"""Synchronisation of an unbounded source: every micro-batch is a chunk against the target that the last one left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..operators import sync
from ..plans.jobs import open_errors
from ..plans.store import Store, settled


def apply_batch(store: Store, batch: DataFrame, batch_id: int, stream: str = "stream") -> None:
    """Synchronises one batch of staged rows as one chunk, once: a batch that is committed already changes nothing.

    Rows need staging_key, doi, indexed_at, content_hash and the canonical columns. Late rows (older than the target) are
    counted as superseded, not dropped.
    """
    rows = settled(batch.withColumns({"execution_id": F.lit(f"{stream}-{batch_id}"), "execution_sequence": F.lit(1).cast("bigint")}))
    cast = lambda df, shape: df.select([F.col(f.name).cast(f.dataType) for f in shape])
    columns = [c for c in schema.CANONICAL_COLUMNS if c != "doi"]

    def work(at: dict) -> None:
        if batch_id <= at["facts"].get(f"batch:{stream}", -1):
            return
        looked = store.touched("target", rows, "doi", at)
        decided = settled(sync.decisions(rows, store.read("target", schema.TARGET, at, buckets=looked)))
        written = store.touched("target", sync.winners(decided), "doi", at)
        target = store.read("target", schema.TARGET, at, buckets=written)
        chunks = sync.chunk_results(decided, rows).withColumn("chunk_sequence", F.lit(batch_id + 1).cast("bigint")).withColumn("execution_id", F.lit(stream))
        errors, top = open_errors(store, sync.row_outcomes(decided, rows).withColumn("execution_id", F.lit(stream)), at)
        store.commit(
            facts={f"batch:{stream}": batch_id, "top_error": top},
            more={"chunks": cast(chunks, schema.CHUNKS), "errors": cast(errors, schema.ERRORS)},
            upserts={"target": (cast(sync.upserted(target, rows, decided, columns, F.current_timestamp()), schema.TARGET), "doi", written, looked)}, base=at,
        )

    store.transact(work)


def start(source: DataFrame, store: Store, checkpoint: str, stream: str = "stream", **trigger) -> StreamingQuery:
    """Runs apply_batch on every micro-batch; exactly once, by the stream's checkpoint and the batch number in the store."""
    return source.writeStream.foreachBatch(lambda batch, n: apply_batch(store, batch, n, stream)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def daily_counts(source: DataFrame, late: str = "2 days") -> DataFrame:
    """Rows by UTC day of their time, closed once the event-time watermark has passed."""
    return source.withWatermark("indexed_at", late).groupBy(F.window("indexed_at", "1 day").alias("day")).agg(F.count("*").alias("n")).select(F.col("day.start").alias("day_start"), "n")
