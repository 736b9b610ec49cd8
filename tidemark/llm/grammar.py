"""Token ids in compressed files: Re-Pair grammars per block, with random access to every document.

A file is a Parquet table of blocks; a block holds consecutive documents in ascending doc_id order as one container
of bytes, all numbers little-endian:

    4 bytes   the mark RPG2
    4 x u32   documents, terminals, rules, symbols
    terminals the block's distinct ids, ascending, u32
    rules     left u16 or u32, right likewise, expansion length u32, each as one array
    documents symbols u32 and ids u32, each as one array
    symbols   u16 or u32, as one array (u16 where terminals + rules fit)

Symbol k below terminals stands for the k-th distinct id, symbol terminals + k for rule k's two symbols, of which each is
a terminal or an earlier rule. No rule crosses a document's end, so a document, or a range of its ids, is read from its
own symbols alone.

The pairs of a block are replaced from the most frequent down, until none occurs twice.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import documents, partitions, shared_dir, slices, utf8
from .tokens import encoder, vocabulary

MARK = b"RPG2"
#: The least count of a pair that gets a rule; pairs down to one SPREAD-th of the highest count are replaced in one pass.
LEAST, SPREAD = 2, 8
TABLE = 18


def _slots(keys: np.ndarray) -> np.ndarray:
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE)
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE)


def repair(symbols: np.ndarray, last: np.ndarray, terminals: int, least: int = LEAST, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What symbols below terminals become, which of them end a document (as last does before), and the rules (left, right).

    Where pairs overlap, the more frequent one is replaced; the other is counted again in the next pass. A rule that is
    left with fewer than `least` uses isn't made, but the most frequent pair always is, so each pass goes on.
    """
    s, last, made = symbols.astype(np.uint32), last.copy(), [np.zeros((0, 2), np.uint32)]
    total, live = terminals, ~last  # where a pair begins that may still occur `least` times
    live[-1:] = False
    while live.any():
        where = np.flatnonzero(live)
        kind = np.uint32 if total <= 1 << 16 else np.uint64
        left, right = s[where], s[where + 1]
        keys, counted = left.astype(kind), np.ones(len(where), bool)
        keys *= kind(total)
        keys += right
        same = np.flatnonzero(left == right)
        if len(same):  # in a run of one symbol every second pair counts
            new = np.append(True, np.diff(where[same]) > 1)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(same)), 0))
            counted[same[(np.arange(len(same)) - begin) % 2 == 1]] = False
        ordered = np.sort(keys[counted] if len(same) else keys)
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        n = np.diff(at, append=len(ordered))
        if n.max() < least:
            break
        good = np.flatnonzero(n >= max(least, int(n.max()) // spread))
        pairs = ordered[at[good[np.argsort(n[good], kind="stable")]]]  # the most frequent last
        table = np.zeros(1 << TABLE, np.int32)
        table[_slots(pairs)] = np.arange(1, len(pairs) + 1, dtype=np.int32)  # of two in one slot the more frequent stays
        slots = _slots(keys)
        met = table[slots]
        again = np.zeros(1 << TABLE, bool)  # a pair that is rare now stays so: later pairs all hold a later symbol
        again[_slots(ordered[at[n >= least]])] = True
        live[where[~again[slots]]] = False
        own = np.flatnonzero(met)
        own = own[(pairs[met[own] - 1] == keys[own]) & counted[own]]
        at, own = where[own], met[own]
        rank = np.zeros(len(s) + 1, np.int32)  # with a place before the first
        rank[at + 1] = own
        won = (own > rank[at]) & (own > rank[at + 2])
        at, own = at[won], own[won]
        used = np.bincount(own, minlength=len(pairs) + 1) >= least
        at, own = at[used[own]], own[used[own]]
        number = np.cumsum(used) - 1
        s[at] = total + number[own].astype(np.uint32)
        last[at] = last[at + 1]
        before = at[at > 0] - 1
        live[at], live[before] = ~last[at], ~last[before]
        stays = np.ones(len(s), bool)
        stays[at + 1] = False
        stays = np.flatnonzero(stays)
        s, last, live = s[stays], last[stays], live[stays]
        live[-1:] = False
        rules = pairs[used[1:]]
        made.append(np.stack([rules // kind(total), rules % kind(total)], 1).astype(np.uint32))
        total += len(rules)
    return s, last, np.concatenate(made)


def flat_places(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of all ranges of n from start, one range after the other."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


def expanded(rules: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols' ids in one array, and where each symbol's begin and how many they are; ids are the terminals'."""
    n, depth = [1] * len(ids), [0] * len(ids)
    for a, b in rules.tolist():
        n.append(n[a] + n[b])
        depth.append(1 + max(depth[a], depth[b]))
    size, level = np.array(n, np.int64), np.array(depth, np.int64)
    at = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), np.uint32)
    flat[: len(ids)] = ids
    for d in range(1, int(level.max(initial=0)) + 1):
        k = np.flatnonzero(level == d)
        left, right = rules[k - len(ids)].T
        flat[flat_places(at[k], size[left])] = flat[flat_places(at[left], size[left])]
        flat[flat_places(at[k] + size[left], size[right])] = flat[flat_places(at[right], size[right])]
    return flat, at, size


def pack(ids: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> bytes:
    """A block of documents with so many ids each, one at least."""
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths) - 1] = True
    met = np.zeros(int(ids.max()) + 1, bool)
    met[ids] = True
    own = np.flatnonzero(met)
    symbols, last, rules = repair((np.cumsum(met) - 1)[ids], last, len(own), least)
    sizes = [1] * len(own)
    for a, b in rules.tolist():
        sizes.append(sizes[a] + sizes[b])
    ends = np.flatnonzero(last) + 1
    kind = np.dtype("<u2" if len(own) + len(rules) <= 1 << 16 else "<u4")
    return b"".join(
        [MARK, struct.pack("<4I", len(lengths), len(own), len(rules), len(symbols)), own.astype("<u4").tobytes(), rules[:, 0].astype(kind).tobytes(), rules[:, 1].astype(kind).tobytes(), np.array(sizes[len(own) :], "<u4").tobytes()]
        + [np.diff(ends, prepend=0).astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), symbols.astype(kind).tobytes()]
    )


class Block:
    """Reads a block; nothing is expanded before it is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MARK:
            raise ValueError("not a block of token ids")
        n, self.terminals, rules, symbols = struct.unpack_from("<4I", data, 4)
        kind, at, parts = np.dtype("<u2" if self.terminals + rules <= 1 << 16 else "<u4"), 20, []
        for k, size in (("<u4", self.terminals), (kind, rules), (kind, rules), ("<u4", rules), ("<u4", n), ("<u4", n), (kind, symbols)):
            parts.append(np.frombuffer(data, k, size, at))
            at += parts[-1].nbytes
        self.own, left, right, self.sizes, counts, self.lengths, self.symbols = parts
        self.rules = np.stack([left, right], 1).astype(np.uint32)
        self.first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    def ids(self) -> np.ndarray:
        """All documents' ids."""
        flat, at, size = expanded(self.rules, self.own)
        return flat[flat_places(at[self.symbols], size[self.symbols])]

    def range(self, document: int, start: int, stop: int) -> list[int]:
        """Ids start to stop of one document; expansion lengths lead to them past all others."""
        out: list[int] = []
        todo, at = [int(x) for x in self.symbols[self.first[document] : self.first[document + 1]]][::-1], 0
        while todo and at < stop:
            x = todo.pop()
            n = int(self.sizes[x - self.terminals]) if x >= self.terminals else 1
            if at + n <= start:
                at += n
            elif x >= self.terminals:
                left, right = self.rules[x - self.terminals].tolist()
                todo += [right, left]
            else:
                out.append(int(self.own[x]))
                at += 1
        return out


def _packed(path: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(path), TaskContext.get().partitionId()
        for k, b in enumerate(slices(batches)):
            ids, lengths = coder.encode(*utf8(b.column("text")))
            doc_ids = b.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({"part": [part], "block": [k], "ids": [int(lengths.sum())], "doc_ids": [doc_ids], "data": [pack(ids, lengths, least)]}, SCHEMA)

    return run


SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("data", pa.binary())])


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, least: int = LEAST) -> None:
    """Writes the ids of docs(doc_id, text) to folder, in ascending doc_id order, null ids first.

    Pairs that occur `least` times in a block get rules.
    """
    docs = documents(docs)
    ordered = docs.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(_packed(path or vocabulary(), least), "part int, block long, ids long, doc_ids array<long>, data binary")
    blocks.write.option("compression", "zstd").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            block = Block(b.column("data")[row].as_py())
            data = memoryview(block.ids().astype("<u4").tobytes())
            ends = np.cumsum(block.lengths, dtype=np.int64)
            n, doc_ids = len(ends), b.column("doc_ids")[row].values
            crc = [zlib.crc32(data[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), block.lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array([b.column("part")[row].as_py()] * n, pa.int32()), pa.array([b.column("block")[row].as_py()] * n, pa.int64()), pa.array(ends - block.lengths), pa.array(block.lengths, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.diff(block.first), pa.int64())],
                ["doc_id", "part", "block", "inner", "n_tokens", "ids_crc32", "n_symbols"],
            )


def read_tokens(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_symbols of every document in folder, from its stored ids."""
    stored = spark.read.parquet(folder)
    own = stored.groupBy("part").agg(F.sum("ids").alias("ids"))
    parts = own.withColumn("before", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("ids")
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored.select("part", "block", "ids").withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part").select("part", "block", (F.col("before") + F.col("inside")).alias("offset"))
    rows = stored.select("part", "block", "doc_ids", "data").mapInArrow(_read, "doc_id long, part int, block long, inner long, n_tokens long, ids_crc32 long, n_symbols long")
    return rows.join(offsets, ["part", "block"]).select("doc_id", (F.col("offset") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")


def token_files(docs: DataFrame, path: str | None = None, folder: str | None = None) -> DataFrame:
    """Writes docs' ids and returns what the files hold, by document.

    Null and empty texts have the end id alone; repeated rows and ids are stored as they come, equal ids by text. An
    empty table writes no block and returns no row.
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, path)
    return read_tokens(docs.sparkSession, folder)
