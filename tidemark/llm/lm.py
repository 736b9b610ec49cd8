"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts, broadcast to the workers.

A count c has level 1 + floor(log2 c). The filter holds one entry for each level of an n-gram from 1 to its own, so a
word's or a pair's level is read by asking for level 1, 2, ... until one is missing; what was never counted is seldom
found, and each level above its own more seldom still. The filter consists of regions, one for each shard of n-grams,
made by the task that has all counts of that shard; a region's bits follow its entries.

A level stands for the mean of the counts that have it. A word's probability after another is a pair's share of its
first word's count, pulled towards the word's own share as far as the first word is rare.

The filter is broadcast as long as it fits in BROADCAST_BYTES. A larger one stays where it was made: each group of
documents sends its distinct words and pairs to the regions of their shards, which answer with levels. Either way the
same entries are probed, so scores are the same, and the work grows with the texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sums import fold
from .text import U, documents, hash_spans, mix, partitions, randoms, settled, slices, spans, trim, utf8

FOLDS, HELD = 5, 1
#: Bits for each entry, probes for each entry, levels, and bytes of filter that are broadcast at most.
BITS, PROBES, LEVELS, BROADCAST_BYTES = 8, 5, 48, 96 << 20
#: Occurrences of a first word at which its pairs and the second word's own share weigh the same.
PULL = 200.0

START, END = randoms(2, 81)
FIRST, SECOND, LEVEL = randoms(3, 82)


def tokens(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens (words lower-cased A-Z, END after each row's), keys of the pairs that they end, and each row's first token."""
    starts, ends, first = spans(raw, rows)
    words = np.insert(hash_spans(raw, starts, ends, fold=True), first[1:], END)
    first = first + np.arange(len(first))
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1]] = START
    return words, mix(before * FIRST + words * SECOND), first


def tallied(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of each one's n."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


def narrow(n: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes as they need."""
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(n) or n.max() <= np.iinfo(t).max)
    return n.astype(kind).tobytes()


def widened(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64) if size else np.zeros(0, np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1].astype(np.int64)  # 1 for 1, 2 for 2 and 3, 3 for 4 to 7


def dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys' places in the order of their shards, and where each shard's begin (one more at the end)."""
    shard = (keys % U(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def restored(keys: np.ndarray, shards: int, rows: pa.Table, column: str) -> np.ndarray:
    """What the shards' rows say of ascending keys: each has its own keys' numbers, in the keys' order."""
    order, cut = dealt(keys, shards)
    out = np.zeros(len(keys), np.int64)
    for p, data in zip(rows.column("p").to_pylist(), rows.column(column), strict=True):
        if data.is_valid:
            own = order[cut[p] : cut[p + 1]]
            out[own] = widened(data.as_py(), len(own))
    return out


def _gathered(shards: int):
    """Over a group of documents: for each shard its words with their counts in training texts, and its pairs likewise."""

    def run(docs: pa.Table) -> pa.Table:
        words, pairs = [(np.zeros(0, U), np.zeros(0, np.int64))], [(np.zeros(0, U), np.zeros(0, np.int64))]
        learnt = 0
        for b in slices(docs.combine_chunks().to_batches(), limit=8 << 20):
            keys, two, first = tokens(*utf8(b.column("text")))
            learn = b.column("learn").to_numpy(zero_copy_only=False)
            learnt += int(learn.sum())
            each = np.repeat(learn, np.diff(first))
            words.append(tallied(keys, each.astype(np.int64)))
            pairs.append(tallied(two[each], np.ones(int(each.sum()), np.int64)))
        q = docs.column("q")[0].as_py()
        out: dict[str, list] = {c: [] for c in ("p", "q", "words", "word_n", "pairs", "pair_n", "learnt")}
        (keys, n), (two, m) = (tallied(*(np.concatenate(c) for c in zip(*parts, strict=True))) for parts in (words, pairs))
        (order, cut), (order_2, cut_2) = dealt(keys, shards), dealt(two, shards)
        for p in range(shards):
            own, own_2 = order[cut[p] : cut[p + 1]], order_2[cut_2[p] : cut_2[p + 1]]
            if len(own) or len(own_2):
                out["p"].append(p)
                out["q"].append(q)
                out["words"].append(keys[own].tobytes())
                out["word_n"].append(narrow(n[own]))
                out["pairs"].append((two[own_2] >> U(32)).astype(np.uint32).tobytes())
                out["pair_n"].append(narrow(m[own_2]))
                out["learnt"].append(0)
        out["learnt"][0] = learnt
        trim()
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), (pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int64()), strict=True)})

    return run


GATHERED = "p int, q int, words binary, word_n binary, pairs binary, pair_n binary, learnt long"


def probes(keys: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What an entry's places are made of: place i is (a + i * b) modulo the region's bits."""
    a = mix(keys + LEVEL * np.asarray(level).astype(U))
    return a >> U(20), mix(a) >> U(44) | U(1)


def region(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The filter of one shard: keys, each at all levels up to its own."""
    total = int(levels.sum())
    bits = -(-total * BITS // 8) * 8
    out = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        a, b = probes(keys[levels >= level], level)
        for i in range(PROBES):
            out[((a + U(i) * b) % U(bits)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little")


def _counted(group: pa.Table) -> pa.Table:
    """One shard: its total counts, back to each group that has the words, and its region of the filter."""
    sent = [np.frombuffer(x.as_py(), U) for x in group.column("words")]
    n = [widened(x.as_py(), len(k)) for x, k in zip(group.column("word_n"), sent, strict=True)]
    words, total = tallied(np.concatenate(sent), np.concatenate(n))
    two = [np.frombuffer(x.as_py(), np.uint32) for x in group.column("pairs")]
    m = [widened(x.as_py(), len(k)) for x, k in zip(group.column("pair_n"), two, strict=True)]
    pairs, pair_total = tallied(np.concatenate(two), np.concatenate(m))
    del two, m
    known = total > 0
    keys = np.concatenate([words[known] >> U(32), pairs.astype(U) | U(1 << 32)])
    counts = np.concatenate([total[known], pair_total])
    levels = np.minimum(level_of(counts), LEVELS - 1)
    order = np.repeat([0, 1], [int(known.sum()), len(pairs)])
    stats = np.stack([np.bincount(order * LEVELS + levels, w, 2 * LEVELS) for w in (None, counts)]).astype(np.int64)
    p = group.column("p")[0].as_py()
    q = [-1, *group.column("q").to_pylist()]
    data = [region(keys, levels).tobytes(), *(narrow(total[np.searchsorted(words, k)]) for k in sent)]
    extra = [stats.tobytes()] + [None] * len(sent)
    learnt = [sum(group.column("learnt").to_pylist())] + [0] * len(sent)
    trim()
    return pa.table({"q": pa.array(q, pa.int32()), "p": pa.array([p] * len(q), pa.int32()), "stats": pa.array(extra, pa.binary()), "counts": pa.array(data, pa.binary()), "learnt": pa.array(learnt, pa.int64())})


COUNTED = "q int, p int, stats binary, counts binary, learnt long"


class Filter:
    """Regions of some shards; the others have no entries here."""

    def __init__(self, shards: int, regions: dict[int, bytes]):
        self.shards, self.bits, self.at = shards, np.zeros(shards, U), np.zeros(shards, np.int64)
        offset = 0
        for p, data in sorted(regions.items()):
            self.bits[p], self.at[p] = 8 * len(data), offset
            offset += len(data)
        self.data = np.frombuffer(b"".join(d for _, d in sorted(regions.items())), np.uint8)

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        """The level of each key of an order (0 for words, 1 for pairs), 0 where it isn't known, by repeated probes."""
        return self.probed((keys % U(self.shards)).astype(np.int64), keys >> U(32), order)

    def probed(self, shard: np.ndarray, short: np.ndarray, order: int) -> np.ndarray:
        """Likewise of keys given by their shards and their upper halves."""
        out = np.zeros(len(short), np.uint8)
        left = np.flatnonzero(self.bits[shard] > 0)
        short, shard = short[left] | U(order << 32), shard[left]
        for level in range(1, LEVELS):
            bits, at = self.bits[shard], self.at[shard]
            hit, (a, b) = np.arange(len(left)), probes(short, level)
            for i in range(PROBES):
                place = ((a[hit] + U(i) * b[hit]) % bits[hit]).astype(np.int64)
                hit = hit[(self.data[at[hit] + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 > 0]
            left, short, shard = left[hit], short[hit], shard[hit]
            if not len(left):
                break
            out[left] = level
        return out


def _distinct_levels(part: Filter, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    found, back = np.unique(keys, return_inverse=True)
    return np.concatenate([part.levels(found, 0)[back], part.levels(pairs, 1)])


def _asked(shards: int):
    """Over a group of documents: for each shard the upper halves of its distinct words and pairs in these texts."""

    def run(docs: pa.Table) -> pa.Table:
        met = [[np.zeros(0, U)], [np.zeros(0, U)]]
        for b in slices(docs.combine_chunks().to_batches(), limit=8 << 20):
            keys, pairs, _ = tokens(*utf8(b.column("text")))
            met[0].append(np.unique(keys))
            met[1].append(np.unique(pairs))
        halves, cuts = [], []
        for keys in (np.unique(np.concatenate(m)) for m in met):
            order, cut = dealt(keys, shards)
            halves.append((keys[order] >> U(32)).astype(np.uint32))
            cuts.append(cut)
        some = [p for p in range(shards) if any(c[p] < c[p + 1] for c in cuts)]
        sent = [pa.array([h[c[p] : c[p + 1]].tobytes() for p in some], pa.binary()) for h, c in zip(halves, cuts, strict=True)]
        q = docs.column("q")[0].as_py()
        trim()
        return pa.table({"p": pa.array(some, pa.int32()), "q": pa.array([q] * len(some), pa.int32()), "words": sent[0], "pairs": sent[1]})

    return run


ASKED = "p int, q int, words binary, pairs binary"


def _answered(made: pa.Table, asked: pa.Table) -> pa.Table:
    """One shard's region of the filter, and what is asked of it: the levels, in the order of the keys sent."""
    region, out = Filter(1, {0: x.as_py() for x in made.column("counts")}), [[], []]
    for order, column in enumerate(("words", "pairs")):
        for x in asked.column(column):
            short = np.frombuffer(x.as_py(), np.uint32).astype(U)
            out[order].append(region.probed(np.zeros(len(short), np.int64), short, order).tobytes())
    trim()
    return pa.table({"q": asked.column("q"), "p": asked.column("p"), "word_levels": pa.array(out[0], pa.binary()), "pair_levels": pa.array(out[1], pa.binary())})


ANSWERED = "q int, p int, word_levels binary, pair_levels binary"


class Model:
    """What turns levels into probabilities: mean counts by order and level, and the corpus' totals."""

    def __init__(self, stats: np.ndarray, learnt: int, pull: float = PULL):
        n, total = stats[0].reshape(2, LEVELS), stats[1].reshape(2, LEVELS)
        self.value = np.where(n > 0, total / np.maximum(n, 1), 1.5 * 2.0 ** (np.arange(LEVELS) - 1))
        self.value[:, 0] = 0
        self.n, self.kinds, self.learnt, self.pull = int(total[0].sum()), int(n[0].sum()), learnt, pull

    @property
    def below(self) -> float:
        return self.n + 0.5 * (self.kinds + 1)

    def scores(self, levels: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each row of tokens; levels has those of all tokens, then those of all pairs."""
        one, two = self.value[0][levels[: first[-1]]], self.value[1][levels[first[-1] :]]
        own = (one + 0.5) / self.below
        before = np.empty_like(one)
        before[1:] = one[:-1]
        before[first[:-1]] = self.learnt
        p = (np.minimum(two, before) + self.pull * own) / (before + self.pull)
        return np.add.reduceat(np.log10(p), first[:-1]) if len(first) > 1 else np.zeros(0)


def _score(shared, model: Model, shards: int):
    """Over a group of documents and what the shards say of its words: counts and, if no filter was broadcast, levels."""

    def run(docs: pa.Table, said: pa.Table) -> pa.Table:
        known, met = np.zeros(0, U), np.zeros(0, U)
        for b in slices(docs.combine_chunks().to_batches(), limit=8 << 20):
            keys, pairs, _ = tokens(*utf8(b.column("text")))
            known = np.union1d(known, keys)
            if shared is None:
                met = np.union1d(met, pairs)
        total = restored(known, shards, said, "counts")
        if shared is None:
            own, paired = (restored(k, shards, said, c).astype(np.uint8) for k, c in ((known, "word_levels"), (met, "pair_levels")))
        out: list[list] = [[], [], [], [], []]
        for b in slices(docs.combine_chunks().to_batches()):
            keys, pairs, first = tokens(*utf8(b.column("text")))
            at = np.searchsorted(known, keys)
            c = total[at]
            logs = np.add.reduceat(np.log10((c + 0.5) / model.below), first[:-1])
            levels = np.concatenate([own[at], paired[np.searchsorted(met, pairs)]]) if shared is None else _distinct_levels(shared.value, keys, pairs)
            for column, values in zip(out, (b.column("doc_id").to_pylist(), np.diff(first), np.add.reduceat((c > 0).astype(np.int64), first[:-1]), logs, model.scores(levels, first)), strict=True):
                column.append(values)
        trim()
        flat = lambda k, kind: pa.array(np.concatenate([np.zeros(0, kind), *out[k]]))
        return pa.table({"doc_id": pa.array([i for part in out[0] for i in part], pa.int64()), "n_tokens": flat(1, np.int64), "n_known": flat(2, np.int64), "base_score": flat(3, np.float64), "score": flat(4, np.float64)})

    return run


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def language_model_scores(docs: DataFrame, folds: int = FOLDS, held: int = HELD, pull: float = PULL, broadcast_bytes: int = BROADCAST_BYTES, shards: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of docs(doc_id, text).

    Counts come from the rows outside the held-out fold; a row without a doc_id isn't held out. base_score is exact:
    every word's count is looked up in the shard that has it. score is the model's log10 probability of all tokens.
    A null or empty text has one token, the end. Repeated rows and ids are scored, and counted, each. An empty table
    gives no row; with no row to learn from, every token's base probability is 1 and its model's likewise.
    """
    spark = docs.sparkSession
    shards = shards or partitions(spark)
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    base = documents(docs).withColumn("q", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    sent = base.withColumn("learn", ~held_out).select("q", "text", "learn").groupBy("q").applyInArrow(_gathered(shards), GATHERED)
    counted = settled(sent.groupBy("p").applyInArrow(_counted, COUNTED))
    made = counted.where("q = -1")
    heads = made.select("p", F.length("counts").alias("size"), "stats", "learnt").collect()
    stats = sum((np.frombuffer(r["stats"], np.int64).reshape(2, -1) for r in heads), np.zeros((2, 2 * LEVELS), np.int64))
    model = Model(stats, sum(r["learnt"] for r in heads), pull)
    said = counted.where("q >= 0").select("q", "p", "counts")
    if sum(r["size"] for r in heads) <= broadcast_bytes:
        regions = {r["p"]: bytes(r["counts"]) for r in made.select("p", "counts").collect()}
        shared = spark.sparkContext.broadcast(Filter(shards, regions))
    else:
        shared = None
        asked = base.select("q", "text").groupBy("q").applyInArrow(_asked(shards), ASKED)
        answers = made.select("p", "counts").groupBy("p").cogroup(asked.groupBy("p")).applyInArrow(_answered, ANSWERED)
        said = said.unionByName(answers, allowMissingColumns=True)
    scored = base.groupBy("q").cogroup(said.groupBy("q")).applyInArrow(_score(shared, model, shards), SCORED)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
