"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over an inverted index with block bounds.

All words are terms. A weight is (1 + log tf) * idf * (1 + g): idf counts all documents, g is twice the log-likelihood
ratio of the word and the label among the examples (0 for a word in none), so a word that goes with a label, be it 0 or 1,
weighs more, and none is left out. Words of the examples and those in at least one of EACH documents are broadcast; the
others, which meet no example, only lengthen a text's vector and are joined to it.

Examples are laid out in blocks of like vectors. Their rare words are postings; their COMMON most frequent ones are a dense
matrix, with every block's largest weight: where the bounds leave few blocks, only these are looked into. Both make
candidates alone, whose cosines are computed again, so the k nearest are exact. Each neighbour votes with a weight that falls
with its distance; a logistic curve fitted to the examples' own leave-one-out votes, found in Spark tasks, turns votes into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sums import fold, labelled
from .text import CHUNK, SPACE, U, documents, hash_spans, settled, slices, spans, trim, utf8

#: Labelled rows that are used at most. Words in one of EACH documents are broadcast; words that a task counts before it gives them on.
EXAMPLES, EACH, HELD_WORDS = 20_000, 1000, 1 << 21
#: Frequent words in the dense matrix, texts that are looked up together, and what single precision may lose of a cosine.
COMMON, BATCH, SLACK = 512, 64, 1e-5
NEIGHBOURS, BLOCK = 15, 64
FOLDS, HELD, THRESHOLD = 5, 0, 0.5

#: What parts terms: all ASCII but letters and digits.
PARTING = SPACE.copy()
PARTING[:128] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    PARTING[_a:_b] = False


def terms(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, lower-cased (A-Z), and for each row its first one's number."""
    starts, ends, first = spans(raw, rows, PARTING)
    return hash_spans(raw, starts, ends, fold=True), first


def distinct(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All terms' hashes, ascending; and row, term's number and number of occurrences of each of a row's terms, in that order."""
    hashes, first = terms(raw, rows)
    every, back = np.unique(hashes, return_inverse=True)
    pairs, n = np.unique(np.repeat(np.arange(len(first) - 1) * max(1, len(every)), np.diff(first)) + back, return_counts=True)
    row, term = np.divmod(pairs, max(1, len(every)))
    return every, row, term, n


def _examples_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        keys, row, back, _ = distinct(*utf8(b.column("text")))
        label = b.column("label").to_numpy() == 1
        yield pa.RecordBatch.from_pydict({"term": keys.view(np.int64), "with_1": np.bincount(back, label[row], len(keys)).astype(np.int64), "n": np.bincount(back, minlength=len(keys)).astype(np.int64)})


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows have each term, added up in the task as far as it can hold them."""
    keys, n = np.zeros(0, U), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_pydict({"term": keys.view(np.int64), "df": n})

    for b in slices(batches):
        new, _, term, _ = distinct(*utf8(b.column("text")))
        more = np.bincount(term, minlength=len(new))
        every, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        keys, n = every, np.bincount(back, np.concatenate([n, more]), len(every)).astype(np.int64)
        if len(keys) > HELD_WORDS:
            yield out()
            keys, n = keys[:0], n[:0]
    yield out()


def evidence(a: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """Twice the log-likelihood ratio of words that a of n examples with label 1 have, against the rate; 0 without both labels."""
    if not 0 < rate < 1:
        return np.zeros(len(n))
    part = lambda o, e: o * np.log(np.where(o > 0, o, 1) / np.where(o > 0, e, 1))
    return np.maximum(0, 2 * (part(a, n * rate) + part(n - a, n * (1 - rate))))


def sparse(raw: np.ndarray, rows: np.ndarray, known: np.ndarray, weigh: np.ndarray) -> list[tuple]:
    """Each row's known terms and their weights, (1 + log tf) * weigh, at unit length; that length; and hashes and tf of its other terms."""
    every, row, term, tf = distinct(raw, rows)
    n = len(rows) - 1
    place = np.minimum(np.searchsorted(known, every), max(0, len(known) - 1))
    met = known[place] == every if len(known) else np.zeros(len(every), bool)
    hit = met[term]
    at, other, other_tf = place[term[hit]], every.view(np.int64)[term[~hit]], tf[~hit]
    weight = (1 + np.log(tf[hit])) * weigh[at]
    cut, rest = np.searchsorted(row[hit], np.arange(n + 1)), np.searchsorted(row[~hit], np.arange(n + 1)).tolist()
    length = np.sqrt(np.add.reduceat(np.append(weight * weight, 0.0), cut[:-1]) * (np.diff(cut) > 0))
    weight /= np.repeat(np.maximum(length, 1e-12), np.diff(cut))
    cut = cut.tolist()
    return [(at[cut[k] : cut[k + 1]], weight[cut[k] : cut[k + 1]], float(length[k]), other[rest[k] : rest[k + 1]], other_tf[rest[k] : rest[k + 1]]) for k in range(n)]


def _flat(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of all ranges of n from start, one range after the other."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


class Index:
    """Examples by block: postings of rare terms, a matrix of common ones, and every block's largest weights.

    Built of vectors of n terms each, one after the other; vectors and postings have less than 2**31 entries together.
    """

    def __init__(self, n: np.ndarray, term: np.ndarray, tf: np.ndarray, weigh: np.ndarray, labels: np.ndarray, ids: np.ndarray, block: int = BLOCK):
        self.block, self.blocks, self.weigh = block, -(-len(n) // block), weigh
        self.logs = 1 + np.log(np.maximum(1, np.arange(int(tf.max(initial=0)) + 1)))
        keys, norms = self._laid_out(n, term, tf, ids)
        self.labels, self.ids = labels[keys], ids[keys]
        moved = _flat((np.cumsum(n) - n)[keys], n[keys])
        self.term, n = term[moved].astype(np.int32, copy=False), n[keys]
        self.weight = self._raw(self.term, tf[moved])
        self.weight /= np.repeat(norms[keys], n)
        del moved
        self.first = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
        common = np.argsort(-np.bincount(self.term, minlength=len(weigh)), kind="stable")[:COMMON]
        self.column = np.full(len(weigh), -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.dense = np.zeros((self.blocks * block, len(common)), np.float32)
        column = self.column[self.term]
        often = column >= 0
        self.dense[owner[often], column[often]] = self.weight[often]
        self.most = self.dense.reshape(self.blocks, block, len(common)).max(1)
        rare = np.flatnonzero(~often).astype(np.int32)
        del column, often
        rare = rare[np.argsort(self.term[rare], kind="stable")]
        self.cut = np.searchsorted(self.term[rare], np.arange(len(weigh) + 1, dtype=np.int32)).astype(np.int32)
        self.posted = np.empty(len(rare), np.int64)  # example and weight, four bytes each
        self.posted.view(np.int32)[::2], self.posted.view(np.float32)[1::2] = owner[rare], self.weight[rare]

    def _raw(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Weights before they are brought to unit length."""
        return self.logs[tf] * self.weigh[term]

    def _laid_out(self, n: np.ndarray, term: np.ndarray, tf: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order in which like vectors, by their three heaviest terms, follow one another; and all vectors' lengths."""
        if not len(n):
            return np.zeros(0, np.int64), np.zeros(0)
        left, first = self._raw(term, tf), np.cumsum(n) - n
        norms = np.sqrt(np.add.reduceat(left * left, first))
        lead, owner = np.zeros((3, len(n)), np.int64), np.repeat(np.arange(len(n), dtype=np.int32), n)
        for k in range(3):
            top = np.flatnonzero(left == np.repeat(np.maximum.reduceat(left, first), n))
            top = top[np.unique(owner[top], return_index=True)[1]]
            lead[k], left[top] = np.where(left[top] > 0, term[top], -1), 0
        return np.lexsort((ids, *lead[::-1])), norms

    def vector(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of the example at that place."""
        a, b = self.first[place], self.first[place + 1]
        return self.term[a:b], self.weight[a:b]

    def nearest(self, query: tuple[np.ndarray, np.ndarray], k: int = NEIGHBOURS, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples (fewer if fewer have a term), nearest first, ties by id."""
        return self.nearest_of([query], k, [without])[0]

    def nearest_of(self, queries: list[tuple], k: int = NEIGHBOURS, without: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """nearest() of each query."""
        out: list = []
        for a in range(0, len(queries), BATCH):
            out += self._batch(queries[a : a + BATCH], k, without[a : a + BATCH] if without else [None] * BATCH)
        return out

    def _batch(self, queries: list[tuple], k: int, without: list) -> list[tuple[np.ndarray, np.ndarray]]:
        size = self.blocks * self.block
        if not size:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        common, scores = np.zeros((len(queries), self.dense.shape[1]), np.float32), []
        for j, (term, weight, *_) in enumerate(queries):
            at = self.column[term]
            common[j, at[at >= 0]] = weight[at >= 0]
            t, w = term[at < 0], weight[at < 0].astype(np.float32)
            n = self.cut[t + 1] - self.cut[t]
            found = self.posted.take(_flat(self.cut[t], n))
            scores.append(np.bincount(found.view(np.int32)[::2], np.repeat(w, n) * found.view(np.float32)[1::2], size).astype(float, copy=False))
        bounds = common @ self.most.T
        full = []
        for j, s in enumerate(scores):
            best = s.reshape(self.blocks, self.block).max(1)
            live = bounds[j] + best >= self._least(best, k) - SLACK
            if live.mean() > 1 / 8:
                full.append(j)
                continue
            s.reshape(self.blocks, self.block)[live] += self.dense.reshape(self.blocks, self.block, -1)[live] @ common[j]
        if full:
            for j, more in zip(full, common[full] @ self.dense.T, strict=True):
                scores[j] += more
        weights = np.zeros(len(self.weigh))
        return [self._exact(q, s, k, w, weights) for q, s, w in zip(queries, scores, without, strict=False)]

    @staticmethod
    def _least(scores: np.ndarray, k: int) -> float:
        """The score of the k-th best, of one more in case one is left out; of blocks' best scores, a bound below it."""
        return float(np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]) if len(scores) > k + 1 else 0.0

    def _exact(self, query: tuple, scores: np.ndarray, k: int, without: int | None, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(scores > max(0.0, self._least(scores.reshape(self.blocks, self.block).max(1), k) - 2 * SLACK))
        places = places[scores[places] >= self._least(scores[places], k) - SLACK]
        places = places[places != without] if without is not None else places
        weights[query[0]] = query[1]
        parts = [slice(a, b) for a, b in zip(self.first[places].tolist(), self.first[places + 1].tolist(), strict=True)]
        found = np.round(np.array([float(weights.take(self.term[p]) @ self.weight[p]) for p in parts]), 9)
        weights[query[0]] = 0
        best = np.lexsort((self.ids[places], -found))[:k]
        best = best[found[best] > 0]
        return places[best], found[best]


class Examples:
    """Known terms with their weights, and the examples; sent as terms and their numbers, from which each worker makes the index."""

    def __init__(self, known: np.ndarray, weigh: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray):
        self.known, self.weigh = known, weigh
        n = np.array([len(t) for t, _ in held], np.int64)
        tf = np.concatenate([np.ones(1, np.int32), *(c for _, c in held)])
        keep = np.flatnonzero(n)
        self.held = n[keep], np.concatenate([np.zeros(0, np.int32), *(t for t, _ in held)]), tf[1:].astype(np.min_scalar_type(int(tf.max()))), labels[keep], ids[keep]

    def __setstate__(self, state: dict) -> None:
        n, term, tf, labels, ids = state.pop("held")
        self.__dict__.update(state)
        self.index = Index(n, term, tf, self.weigh, labels, ids)
        del n, term, tf
        trim()


class Votes:
    """What turns neighbours into a probability."""

    def __init__(self, labels: np.ndarray, empty: np.ndarray):
        """labels of all examples, and which of them have no term."""
        self.rate = float(labels.mean()) if len(labels) else 0.5
        self.none = float((labels[empty].sum() + self.rate) / (empty.sum() + 1)) if len(labels) else 0.5
        self.slope, self.shift = 1.0, 0.0

    def odds(self, labels: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of the neighbours' weighted votes, with one vote at the examples' own rate."""
        weights = 1 / (1.05 - cosines)
        p = min(max((weights @ labels + self.rate) / (weights.sum() + 1), 1e-9), 1 - 1e-9)
        return float(np.log(p / (1 - p)))

    def calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """Newton steps on the logistic loss of slope and shift, with a weak pull to 1 and 0."""
        if len(z) < 10 or y.min() == y.max():
            return
        x, w, start = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0]), np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
            w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - y) + (w - start))
        if np.isfinite(w).all() and w[0] > 0:
            self.slope, self.shift = w.tolist()

    def score(self, labels: np.ndarray, cosines: np.ndarray) -> float:
        """Probability of label 1 by the neighbours; without any, the rate of such examples."""
        if not len(labels):
            return self.none
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.odds(labels, cosines) + self.shift, -30, 30))))


def _held(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in slices(batches):
            every, row, term, tf = distinct(*utf8(b.column("text")))
            n = b.num_rows
            term, tf, cut = np.searchsorted(known, every)[term].astype(np.int32), tf.astype(np.int32), np.searchsorted(row, np.arange(n + 1)).tolist()
            parts = lambda x: pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in range(n)], pa.binary())
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "label": b.column("label"), "terms": parts(term), "tf": parts(tf)})

    return run


NEAR = "row long, doc_id long, labels array<double>, neighbours array<long>, cosines array<double>, length double, other array<long>, tf array<long>"


def _left_out(shared, votes: Votes):
    """Over the ids of examples: the log odds that the others' votes give each, and its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        places = dict(zip(index.ids.tolist(), range(len(index.ids)), strict=True))
        for b in batches:
            own = [places[i] for i in b.column("doc_id").to_pylist() if i in places]
            for k in range(0, len(own), BATCH):
                part = own[k : k + BATCH]
                found = index.nearest_of([index.vector(p) for p in part], NEIGHBOURS, part)
                odds = [votes.odds(index.labels[at], cosines) for at, cosines in found]
                yield pa.RecordBatch.from_pydict({"place": pa.array(part, pa.int64()), "odds": pa.array(odds, pa.float64()), "positive": pa.array(index.labels[part] == 1, pa.bool_())})
        trim()

    return run


def _near(shared):
    """Neighbours by the known terms alone; a text's other terms change all its cosines by one factor, not their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index
        for b in slices(batches, CHUNK // 2):
            v = sparse(*utf8(b.column("text")), model.known, model.weigh)
            found = index.nearest_of(v)
            lists = lambda x, kind: pa.array(x, pa.list_(kind))
            yield pa.RecordBatch.from_pydict({
                "row": b.column("row"), "doc_id": b.column("doc_id"), "labels": lists([index.labels[p] for p, _ in found], pa.float64()), "neighbours": lists([index.ids[p] for p, _ in found], pa.int64()), "cosines": lists([c for _, c in found], pa.float64()),
                "length": pa.array([x[2] for x in v], pa.float64()), "other": lists([x[3] for x in v], pa.int64()), "tf": lists([x[4] for x in v], pa.int64()),
            })

    return run


def _score(votes: Votes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, near = [], []
            length, other = b.column("length").to_numpy(), b.column("other_sq").to_numpy()
            shrink = length / np.sqrt(np.maximum(length * length + other, 1e-24))
            for labels, cosines, by in zip(b.column("labels").to_pylist(), b.column("cosines").to_pylist(), shrink.tolist(), strict=True):
                c = np.round(np.array(cosines, float) * by, 9)
                scores.append(votes.score(np.array(labels, float), c))
                near.append(c)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), b.column("neighbours"), pa.array(near, pa.list_(pa.float64()))], ["doc_id", "score", "neighbours", "cosines"])

    return run


def counted(docs: DataFrame) -> tuple[DataFrame, int]:
    """term and df, the number of rows that have it, of all words of docs(text); and the number of rows."""
    return settled(docs.mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))), docs.count()


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held: int = HELD, examples: int = EXAMPLES, words: tuple[DataFrame, int] | None = None, each: int = EACH) -> tuple:
    """A broadcast of Examples, and Votes: the index over at most `examples` labelled rows outside the held-out fold, one for each text. words: counted(docs)."""
    docs = documents(docs)
    table, rows_n = words or counted(docs)
    share = docs.sparkSession.sparkContext.broadcast
    chosen = labelled(docs, labels, label, folds, held, examples)
    once = chosen.groupBy(F.md5("text").alias("text_md5")).agg(F.min("doc_id").alias("doc_id"))
    chosen = chosen.join(F.broadcast(once.select("doc_id").distinct()), "doc_id")
    total, positives = chosen.agg(F.count("*"), F.sum((F.col("label") == 1).cast("long"))).first()
    counts = chosen.mapInArrow(_examples_terms, "term long, with_1 long, n long").groupBy("term").agg(F.sum("with_1").alias("a"), F.sum("n").alias("n"))
    kept = table.join(counts, "term", "left").where(F.col("n").isNotNull() | (F.col("df") * each >= rows_n)).select("term", "df", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("n", F.lit(0)).alias("n")).toArrow()
    known, df, a, n = (kept.column(c).to_numpy() for c in ("term", "df", "a", "n"))
    order = np.argsort(known.view(U))
    known, df, a, n = known[order].view(U), df[order], a[order], n[order]
    weigh = (np.log((rows_n + 1) / (df + 1)) + 1) * (1 + evidence(a, n, (positives or 0) / max(1, total)))
    sent = chosen.mapInArrow(_held(share(known)), "doc_id long, label int, terms binary, tf binary")
    sent = settled(sent.groupBy("doc_id").agg(F.min(F.struct("terms", "tf", "label")).alias("e")).select("doc_id", "e.*"))
    del kept, df, a, n
    rows = sorted(((r["doc_id"], r["terms"], r["tf"], r["label"] == 1) for r in sent.toLocalIterator()), key=lambda r: r[0])  # a partition at a time
    vectors = [(np.frombuffer(t, np.int32), np.frombuffer(c, np.int32)) for _, t, c, _ in rows]
    labels, ids = np.array([r[3] for r in rows], float), np.array([r[0] for r in rows], np.int64)
    votes = Votes(labels, np.array([not len(t) for t, _ in vectors], bool))
    shared = share(Examples(known, weigh, vectors, labels, ids))
    del known, weigh, vectors, rows
    left = sorted((r["place"], r["odds"], r["positive"]) for r in sent.select("doc_id").mapInArrow(_left_out(shared, votes), "place long, odds double, positive boolean").collect())
    votes.calibrate(np.array([z for _, z, _ in left]), np.array([y for *_, y in left], float))
    return shared, votes


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS, held: int = HELD, examples: int = EXAMPLES, each: int = EACH) -> DataFrame:
    """doc_id, held_out, score, predicted, and as evidence the neighbours with their cosines, for every row of docs.

    A text that shares no word with an example, null and empty ones too, has no neighbour and the rate of label 1 among
    examples without words. Repeated rows and ids get theirs each; a row without a doc_id is not held out. With labels
    of one kind only every neighbour votes for it; without labels every score is a half.
    """
    docs = documents(docs)
    words = counted(docs)
    shared, votes = fitted(docs, labels, "toxic", folds, held, examples, words, each)
    near = settled(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_near(shared), NEAR))
    pairs = near.select("row", F.explode(F.arrays_zip("other", "tf")).alias("p")).select("row", F.col("p.other").alias("term"), F.col("p.tf").alias("tf"))
    weight = (1 + F.log("tf")) * (F.log(F.lit(words[1] + 1) / (F.col("df") + 1)) + 1)
    lengths = pairs.join(words[0], "term").groupBy("row").agg(F.sum(weight * weight).alias("other_sq"))
    whole = near.drop("other", "tf").join(lengths, "row", "left").select("doc_id", "labels", "neighbours", "cosines", "length", F.coalesce("other_sq", F.lit(0.0)).alias("other_sq"))
    scored = whole.mapInArrow(_score(votes), "doc_id long, score double, neighbours array<long>, cosines array<double>")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "neighbours", "cosines")
