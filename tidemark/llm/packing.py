"""Packs token sequences: length combinations weighted by non-negative least squares, residuals placed greedily.

A block of documents is packed by itself, so nothing is gathered beyond a task: documents are cut at every `window`
ids, their last pieces are counted by length class, and shallow combinations of classes that fill a window get repeat
counts from a non-negative least squares fit to those counts, rounded down. Pieces that are left over go to the
sequence with the least sufficient space, and are cut where that fills a sequence; what no sequence takes opens new
ones. A block's last sequence is cut to lengths that are powers of two where that saves padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .text import documents, slices, trim, utf8
from .tokens import encoder, vocabulary

WINDOW = 2048
#: Length classes to a window, pieces to a combination, ids that a block gathers, and the shortest piece cut off to fill a sequence.
CLASSES, DEPTH, BLOCK, SLIVER = 64, 3, 1_000_000, 16


@lru_cache
def combinations(classes: int, depth: int) -> np.ndarray:
    """How often each class stands in each combination of up to depth classes that fills the window."""
    out = []

    def add(left: int, most: int, row: list[int]) -> None:
        if left == 0:
            out.append(np.bincount(row, minlength=classes + 1)[1:])
        elif len(row) < depth:
            for c in range(min(left, most), 0, -1):
                add(left - c, c, [*row, c])

    add(classes, classes, [])
    return np.array(out, float).T


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method of Lawson and Hanson."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(3 * a.shape[1]):
        w = a.T @ (b - a @ x)
        w[free] = -np.inf
        k = int(w.argmax())
        if w[k] <= tolerance:
            break
        free[k] = True
        for _ in range(3 * a.shape[1]):
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (z <= 0)
            if not low.any():
                x = z
                break
            step = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x += step * (z - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


def plan(lengths: np.ndarray, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH, sliver: int = SLIVER) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) pieces, which cover every id of every document once."""
    out: list[list[tuple[int, int, int]]] = []
    unit, pools = window // classes, [[] for _ in range(classes + 1)]
    for d, n in enumerate(lengths.tolist()):
        whole = n // window * window
        out += [[(d, s, window)] for s in range(0, whole, window)]
        if n > whole:
            pools[-(-(n - whole) // unit)].append((d, whole, n - whole))
    counts = np.array([len(p) for p in pools[1:]], float)
    spaces: list[tuple[int, int]] = []  # (free ids, sequence), ascending
    shapes = combinations(classes, depth)
    repeats = nnls(shapes, counts) if counts.any() else np.zeros(shapes.shape[1])
    for k in np.argsort(-repeats, kind="stable"):
        parts = np.repeat(np.arange(classes), shapes[:, k].astype(int)) + 1
        need = np.bincount(parts, minlength=classes + 1)
        for _ in range(min([int(repeats[k] + 1e-9), *(len(pools[c]) // need[c] for c in set(parts.tolist()))])):
            pieces = [pools[c].pop() for c in parts]
            if free := window - sum(p[2] for p in pieces):
                spaces.append((free, len(out)))
            out.append(pieces)
    spaces.sort()
    left = sorted((p for pool in pools for p in pool), key=lambda p: -p[2])
    for d, s, n in left:
        while n:
            k = bisect_left(spaces, (n, -1))
            if k == len(spaces) and spaces and spaces[-1][0] >= sliver:  # none holds it whole: fill the largest space
                k -= 1
            elif k == len(spaces):
                spaces.append((window, len(out)))
                out.append([])
            free, q = spaces.pop(k)
            take = min(free, n)
            out[q].append((d, s, take))
            s, n = s + take, n - take
            if free > take:
                insort(spaces, (free - take, q))
    for free, q in spaces[::-1]:  # fullest last; an emptier one feeds the others where it can
        used = window - free
        if used > window // 2 or free < window // 8:
            continue
        out[q], rest = _split(out[q], 1 << (used.bit_length() - 1))
        while rest and (n := sum(p[2] for p in rest)) >= window // 16:
            head, rest = _split(rest, 1 << (n.bit_length() - 1))
            out.append(head)
        if rest:
            out.append(rest)
    return out


def _split(pieces: list[tuple[int, int, int]], at: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    head, rest = [], []
    for d, s, n in pieces:
        a = min(n, at)
        if a:
            head.append((d, s, a))
        if n > a:
            rest.append((d, s + a, n - a))
        at -= a
    return head, rest


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, window: int, classes: int, depth: int):
    def block(held: list[tuple[pa.Array, np.ndarray, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        ids, lengths = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        sequences = plan(lengths, window, classes, depth)
        data, base = memoryview(ids.astype("<u4", copy=False)).cast("B"), np.cumsum(lengths) - lengths
        d, s, n = np.fromiter((x for q in sequences for p in q for x in p), np.int64).reshape(-1, 3).T
        sizes = [len(q) for q in sequences]
        ends = np.cumsum(n)
        number = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.repeat((ends - n)[np.cumsum([0, *sizes[:-1]])], sizes)
        at = (base[d] + s) * 4
        crc = [zlib.crc32(data[a : a + 4 * k]) for a, k in zip(at.tolist(), n.tolist(), strict=True)]
        doc_ids = pa.concat_arrays([h[0] for h in held]).take(pa.array(d))
        columns = [doc_ids, s, n, np.array(crc, np.int64), lengths[d], number + first, ends - n - begin]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in SCHEMA.split(", ")]), first + len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size = encoder(path), [], 0
        first = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            ids, lengths = coder.encode(*utf8(b.column("text")))
            held.append((b.column("doc_id"), ids, lengths))
            size += len(ids)
            if size >= BLOCK:
                out, first = block(held, first)
                held, size = [], 0
                yield out
        if held:
            yield block(held, first)[0]
        held.clear()
        trim()

    return run


def packed(docs: DataFrame, path: str | None = None, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH) -> DataFrame:
    """The pieces of docs(doc_id, text) and their places in sequences of at most window ids.

    Null and empty texts have the end id alone. Rows that repeat, or share an id, are packed each. Sequences are
    numbered by the reading task (times 2**40) and within it. A window is a power of two, and a multiple of classes.
    """
    if window & (window - 1) or window % classes:
        raise ValueError("window must be a power of two and a multiple of classes")
    return documents(docs).mapInArrow(_pack(path or vocabulary(), window, classes, depth), SCHEMA)
