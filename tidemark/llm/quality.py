"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network with a temperature.

Every word and every shape of a word (case, digits, ending, length, repetition) falls in one of a fixed number of
slots, and has a sparse random index vector by its slot. A slot's vector is the sum of the index vectors of all its
neighbours in the whole corpus. A document is the mean of its words' and of its shapes' vectors, with three plain
numbers. The network is fitted to a bounded sample of labelled rows, its temperature to a part of them left out of the
fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .sums import SCHEMA as SUMS
from .sums import blocks, fold, labelled, summed, tasks_of
from .text import CHUNK, U, documents, hash_spans, randoms, slices, spans, trim, utf8

#: Slots for words and for shapes, dimensions, and how many of an index vector's are not zero.
WORDS, SHAPES, SIZE, SPARSE = 1 << 14, 1 << 9, 32, 3
#: Rows that the network is fitted to at most; hidden units; passes.
EXAMPLES, HIDDEN, EPOCHS = 20_000, 32, 40
FOLDS, HELD, THRESHOLD = 4, 2, 0.7

_draws = randoms((WORDS + SHAPES) * SPARSE, 61).reshape(-1, SPARSE)
PLACES = ((_draws >> U(8)) % U(SIZE)).astype(np.int64)
SIGNS = np.where((_draws >> U(40)) & U(1), 1, -1)

UPPER, LETTER, DIGIT = (np.zeros(256, bool) for _ in range(3))
UPPER[65:91] = True
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT[48:58] = True


def slots(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's slot, its shape's slot, and for each row its first word's number."""
    starts, ends, first = spans(raw, rows)
    hashes = hash_spans(raw, starts, ends, fold=True)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int32)])
        return sums[ends] - sums[starts]

    n, letters = ends - starts, count(LETTER)
    marks = n - letters - count(DIGIT)
    same = np.zeros(len(n), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(n)]] = False
    upper = count(UPPER)
    shape = (
        (UPPER[raw[starts]] if len(n) else same).astype(np.int64)
        + 2 * ((upper > 1) & (upper == letters))
        + 4 * (n > letters + marks)
        + 8 * np.minimum(marks, 3)
        + 32 * same
        + 64 * (letters == 0)
        + 128 * np.searchsorted([3, 6, 10], n, side="right")
    )
    return (hashes % U(WORDS)).astype(np.int64), WORDS + shape, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((WORDS + SHAPES) * SIZE, np.int64)

    def add(slot: np.ndarray, neighbour: np.ndarray) -> None:
        for k in range(SPARSE):
            total[:] += np.bincount(slot * SIZE + PLACES[neighbour, k], SIGNS[neighbour, k], len(total)).astype(np.int64)

    for b in slices(batches, CHUNK):
        words, shapes, first = slots(*utf8(b.column("text")))
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        left, right = [], []
        for stream, reach in ((words, 2), (shapes, 1)):
            for step in range(1, reach + 1):
                inside = np.flatnonzero(row[step:] == row[:-step])
                left += [stream[inside], stream[inside + step]]
                right += [stream[inside + step], stream[inside]]
        add(np.concatenate([*left, words]), np.concatenate([*right, shapes]))
    yield blocks(total)
    trim()


def vectors(docs: DataFrame) -> np.ndarray:
    """A row of unit length for each slot that the corpus has; a fixed size, whatever the corpus."""
    size = (WORDS + SHAPES) * SIZE
    v = summed(docs.mapInArrow(_count, SUMS), size, tasks_of(docs)).reshape(-1, SIZE).astype(np.float32)
    norms = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norms > 0, norms, 1)


def pooled(raw: np.ndarray, rows: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The features of each row; an empty text's are zero."""
    words, shapes, first = slots(raw, rows)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * SIZE + 3), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        for k, stream in enumerate((words, shapes)):
            out[some, k * SIZE : (k + 1) * SIZE] = np.add.reduceat(v[stream], first[some]) / n[some, None]
        row = np.repeat(np.arange(len(n)), n)
        kinds = np.bincount(np.unique(row * WORDS + words) // WORDS, minlength=len(n))
        out[some, -3] = np.log1p(n[some])
        out[some, -2] = kinds[some] / n[some]
        out[some, -1] = (np.diff(rows)[some] / n[some]).clip(0, 40) / 10
    return out


class Network:
    """One hidden layer of tanh units and one output, by Adam on the cross-entropy; fitted in float64 from one seed."""

    def fit(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(x))
        fit, rest = order[len(x) // 5 :], order[: len(x) // 5]
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, s, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(epochs):
            for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
                a, t = x[batch], y[batch]
                h = np.tanh(a @ w[0] + w[1])
                d = (1 / (1 + np.exp(-(h @ w[2] + w[3]).clip(-40, 40))) - t) / len(t)
                back = np.outer(d, w[2]) * (1 - h**2)
                step += 1
                for k, g in enumerate((a.T @ back + 1e-4 * w[0], back.sum(0), h.T @ d + 1e-4 * w[2], d.sum(keepdims=True))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    w[k] = w[k] - 0.01 * 0.93**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        self.w, self.temperature, self.seen, self.rate = w, 1.0, len(rest), float(y.mean())
        if len(rest) and 0 < y[rest].sum() < len(rest):
            z = self._logits(x[rest])
            grid = np.geomspace(1, 16, 61)
            loss = [(np.logaddexp(0, z / t) - y[rest] * z / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-(self._logits((x - self.mean) / self.scale) / self.temperature).clip(-40, 40)))
        return (p * self.seen + self.rate) / (self.seen + 1)  # no surer than the rows that it was calibrated on allow


class Constant:
    """Stands in where the labels are of one kind or there are none: their rate, a half without any."""

    def __init__(self, rate: float):
        self.rate = rate

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.rate)


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, CHUNK):
            x = pooled(*utf8(b.column("text")), shared.value)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "label": b.column("label"), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    return run


def _score(v, model, place: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, CHUNK):
            x = pooled(*utf8(b.column("text")), v.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:place], pa.array(model.value.probability(x), pa.float64()), *b.columns[place:]], [*b.schema.names[:place], name, *b.schema.names[place:]])
        trim()

    return run


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held: int = HELD, examples: int = EXAMPLES) -> tuple[np.ndarray, Network | Constant]:
    """Word vectors of all docs, and the model fitted to at most `examples` labelled rows outside the held-out fold."""
    docs = documents(docs)
    v = vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(v)
    rows = labelled(docs, labels, label, folds, held, examples).mapInArrow(_features(shared), "doc_id long, label int, x binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = np.array([r["label"] == 1 for r in rows], float)
    if len(rows) < 10 or y.min() == y.max():
        return v, Constant(float(y.mean()) if len(rows) else 0.5)
    return v, Network().fit(np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float), y)


def with_score(docs: DataFrame, v: np.ndarray, model: Network | Constant, name: str = "score") -> DataFrame:
    """docs(text, ...) with the probability of label 1 in one more column, the last."""
    share = docs.sparkSession.sparkContext.broadcast
    place = len(docs.columns)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(_score(share(v), share(model), place, name), schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS, held: int = HELD, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs(doc_id, text).

    A null or empty text has the features of no words and gets a score like any other. Repeated rows and ids get theirs
    each; a row without a doc_id is not held out. Without labels of both kinds every score is their rate, or a half.
    """
    docs = documents(docs)
    v, model = fitted(docs, labels, "quality", folds, held, examples)
    scored = with_score(docs, v, model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
