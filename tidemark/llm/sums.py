"""Sums of arrays over all tasks, and the crc32 folds of labels."""

from __future__ import annotations



import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Arrays that one task adds up at most, and values in one block of an array.
FAN, BLOCK = 64, 1 << 15


def blocks(total: np.ndarray) -> pa.RecordBatch:
    """A task's array as rows of blocks that aren't all zero; whole numbers take as few bytes as they need."""
    n = -(-len(total) // BLOCK)
    rows = [total[k * BLOCK : (k + 1) * BLOCK] for k in range(n)]
    some = [k for k in range(n) if rows[k].any()]
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if t == np.int64 or not total.size or np.abs(total).max() <= np.iinfo(t).max)
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    return pa.RecordBatch.from_pydict(
        {"block": pa.array(some, pa.int32()), "part": pa.array([part] * len(some), pa.int64()), "bytes": pa.array([np.dtype(kind).itemsize] * len(some), pa.int32()), "counts": pa.array([rows[k].astype(kind).tobytes() for k in some], pa.binary())}
    )


SCHEMA = "block int, part long, bytes int, counts binary"


def _add(group: pa.Table) -> pa.Table:
    total: np.ndarray | int = 0
    for size, data in zip(group.column("bytes").to_pylist(), group.column("counts"), strict=True):
        total = total + np.frombuffer(data.as_py(), f"<i{size}").astype(np.int64)
    return pa.table({"block": group.column("block").slice(0, 1), "part": group.column("part").slice(0, 1), "bytes": pa.array([8], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def summed(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The sum of the arrays of so many tasks, each given by blocks(); added in a tree, so no task holds more than FAN."""
    while True:
        tasks = -(-tasks // FAN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("block", "part").applyInArrow(_add, SCHEMA)
        if tasks <= 1:
            break
    out = np.zeros(size, np.int64)
    for row in parts.select("block", "counts").collect():
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] += np.frombuffer(row["counts"], np.int64)
    return out


def tasks_of(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int) -> DataFrame:
    """doc_id, text and label of at most `most` labelled rows outside the held-out fold, chosen by a hash of doc_id.

    A doc_id with several labels has the largest. Rows without doc_id or label don't count.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(fold(F.col("doc_id"), folds) != held).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(most)
    return docs.join(F.broadcast(chosen), "doc_id")


