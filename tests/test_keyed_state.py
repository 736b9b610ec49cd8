"""Keyed state in a stream against a plain rule, with a restart between batches."""

import random

from pyspark.sql import functions as F

from tidemark.streaming import keyed_state

ROWS = "doi string, indexed_at timestamp, content_hash string, staging_key bigint"


def by_hand(batches):
    """Decisions on each doi of each batch, and the state afterwards."""
    kept, out = {}, []
    for batch in batches:
        for doi in {r[0] for r in batch}:
            own = [r for r in batch if r[0] == doi]
            top = max(r[1] for r in own)
            tied = [r for r in own if r[1] == top]
            hashes, was = {r[2] for r in tied}, kept.get(doi)
            if len(hashes) > 1:
                d = "GROUP_CONFLICT"
            elif was is None:
                d = "INSERTED"
            elif top < was[0]:
                d = "SUPERSEDED"
            elif top == was[0]:
                d = "NO_OP" if hashes == {was[1]} else "CONFLICT"
            else:
                d = "INDEX_ADVANCED" if hashes == {was[1]} else "UPDATED"
            if d in ("INSERTED", "UPDATED", "INDEX_ADVANCED"):
                kept[doi] = (top, min(hashes))
            out.append((doi, d, len(own), len(tied), min(r[3] for r in tied), *kept.get(doi, (None, None))))
    return out, kept


def test_random_batches_with_restarts(spark, tmp_path):
    keyed_state.use_rocksdb(spark)
    r, key, batches = random.Random(12), 0, []
    for _ in range(5):
        batch = []
        for _ in range(r.choice((3, 40, 120))):
            key += 1
            batch.append((r.choice(["hot", *(f"d{k}" for k in range(25))]), r.randrange(12), r.choice("xyz"), key))
        batches.append(batch)
    for k, batch in enumerate(batches):
        at = f"{tmp_path}/in"
        spark.createDataFrame(batch, "doi string, s long, content_hash string, staging_key bigint").withColumn("indexed_at", F.timestamp_seconds("s")).select("doi", "indexed_at", "content_hash", "staging_key").coalesce(1).write.mode("append").parquet(at)
        source = spark.readStream.schema(ROWS).parquet(at)  # each turn starts the query anew from its checkpoint
        seen = []
        query = keyed_state.decisions(source).writeStream.outputMode("update").foreachBatch(lambda df, n, seen=seen: seen.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        query.awaitTermination(180)
        before = len(by_hand(batches[:k])[0])
        want = by_hand(batches[: k + 1])[0][before:]
        got = [(x[0], x[1], x[2], x[3], x[5], None if x[8] is None else x[8] // 1_000_000, x[9]) for x in seen]
        assert sorted(got) == sorted(want)
        assert all(x[2] == x[3] + x[4] for x in seen)
