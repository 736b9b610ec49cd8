"""Byte-level text helpers that run inside Spark tasks, and the few session helpers the operators share.

Words are the maximal runs of bytes other than U+0020 and U+0009..U+000D, so a word is the same whether a text is
looked at as code points or as UTF-8. A word is hashed to 64 bits by a polynomial over a random byte table, taken from
prefix sums, which needs no Python loop over words.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers of a seed."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed) * U(1 << 32)) * U(0x9E3779B97F4A7C15)) | U(1)


STEP = int(randoms(1, 7)[0])
BYTES = randoms(256, 1)
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []
_kept: dict[str, object] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of STEP and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(CHUNK, 1 << int(n).bit_length())
        _powers.clear()
        for step in (STEP, pow(STEP, -1, 1 << 64)):
            table = np.full(size, step, U)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=U, out=table))
    return _powers[0][:n], _powers[1][:n]


def kept(name: str, make):
    """What make() gave under that name, kept for the worker's next tasks; a worker keeps one such thing at a time."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row's begin and end; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def spans(raw: np.ndarray, rows: np.ndarray, parting: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row its first word's number (one more entry at the end).

    parting tells for each byte whether it stands between words.
    """
    if not raw.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    ink = ~parting[raw]
    first = np.zeros(raw.size + 1, bool)
    first[rows] = True
    first = first[:-1]
    before = np.empty_like(ink)
    before[0], before[1:] = False, ink[:-1]
    starts = np.flatnonzero(ink & (first | ~before))
    after = np.empty_like(ink)
    after[-1], after[:-1] = True, first[1:] | ~ink[1:]
    ends = np.flatnonzero(ink & after) + 1
    return starts, ends, np.searchsorted(starts, rows)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each span; fold lower-cases A-Z. Spans ascend and don't overlap."""
    table, out, k = FOLDED if fold else BYTES, np.empty(len(starts), U), 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK, side="right")))
        a, b = int(starts[k]), int(ends[stop - 1])
        up, down = powers(b - a)
        sums = np.empty(b - a + 1, U)
        sums[0] = 0
        np.cumsum(table[raw[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[k:stop] - a, ends[k:stop] - a
        out[k:stop] = (sums[e] - sums[s]) * down[s]
        k = stop
    return mix(out)


def windows(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each run of n words inside a row, the run's first word's number, and the first run of each row (one more at the end)."""
    if len(words) < n:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    total = np.zeros(len(words) - n + 1, U)
    for j, c in enumerate(randoms(n, 11)):
        total += words[j : len(words) - n + 1 + j] * c
    left = np.maximum(np.diff(rows) - (n - 1), 0)
    firsts = np.concatenate([[0], np.cumsum(left)])
    at = np.arange(firsts[-1]) + np.repeat(rows[:-1] - firsts[:-1], left)
    return mix(total[at]), at, firsts


def trim() -> None:
    """Gives freed memory back, so that a worker between two tasks holds little."""
    if _powers and len(_powers[0]) > CHUNK:
        _powers.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], limit: int = 2 * CHUNK, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about limit bytes at most (one row, if that alone is larger)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(sizes)
        k = 0
        while k < b.num_rows:
            stop = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + limit, side="right")))
            yield b.slice(k, stop - k)
            k = stop
    trim()


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text of a table of documents, whatever else it holds; other named columns too."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def fresh(name: str, columns: list[str]) -> str:
    """name, with as many underscores behind it as it takes to be none of columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A folder of our own stands in only where the session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not found:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        found = tempfile.mkdtemp(prefix="tidemark-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared folder, its lineage cut: lost executors cost no earlier work, and no work is done twice."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def released(df: DataFrame) -> DataFrame:
    """df, with shuffles and checkpoints that no plan holds any more dropped; Spark does so when the driver collects garbage, which may be long after."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which follows the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
