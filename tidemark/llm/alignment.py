"""Alignment of two tokenizers' ids over the same bytes, and corpus-wide counts of the id pairs that overlap.

A is a byte-level tokenizer of the tokenizers library, B a merge-type piece model. Tokens of both are the nodes of a
bipartite graph, linked where their byte ranges overlap; the graph's components, found by union-find, are the smallest
groups of tokens that cover the same bytes, and a group's members expand to its links.

Both tokenizers cut before white space that follows ink, so a text falls into units (a word with the white space before
it) that are aligned each by itself; a task aligns each distinct unit once, and a document's result is put together from
its units'. Pairs are counted by tasks over the documents they read, then by groupBy; what a document's links add up to
comes from a second reading, with the counts broadcast while they are few enough, else by a join on the pair.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceEncoder, units
from .text import SPACE, documents, kept, settled, slices, trim, utf8
from .tokens import LINE, vocabulary

#: Pairs whose counts are broadcast at most (16 bytes each), and bytes of groups that a worker keeps.
BROADCAST_PAIRS, KEPT_BYTES = 1 << 22, 1 << 26
#: White space beyond ASCII, and controls that some rules take for it; a text that holds any is cut after ASCII signs alone.
RARE_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printing signs for themselves, the rest by their order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def components(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component under the links (a, b): union of roots, then compression, until no link joins two roots."""
    parent = np.arange(nodes)
    while True:
        x, y = parent[a], parent[b]
        if (x == y).all():
            return parent
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All positions of runs that begin at `at` and are n long, one run after another."""
    before = np.cumsum(n) - n
    return np.repeat(at - before, n) + np.arange(n.sum())


class Bytes:
    """The bytes of each id, end to end."""

    def __init__(self, values: list[bytes]):
        self.n = np.fromiter(map(len, values), np.int64, len(values))
        self.at = np.cumsum(self.n) - self.n
        self.flat = np.frombuffer(b"".join(values), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.at[ids], self.n[ids])]


class Aligner(PieceEncoder):
    """A worker's units by their hash: numbers of tokens, groups and links, the groups as text, and the linked id pairs."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a, self.b, self.counts = Tokenizer.from_file(path_a), PieceEncoder(path_b), None
        self.a.encode_special_tokens = True
        byte_of, special = byte_of_sign(), {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        names = {i: t.encode() if i in special else bytes(byte_of[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.a_bytes, self.b_bytes = Bytes([names.get(i, b"") for i in range(max(names) + 1)]), Bytes(self.b.model.bytes)
        self.top = max(len(self.a_bytes.n), len(self.b_bytes.n))
        self.signs = pa.array([b"%d%s" % (i, end) for end in (b",", b"|", b";", b"") for i in range(self.top)], pa.large_binary())
        self.cuts = np.where(SPACE[:, None], False, SPACE[None, :]) & ~self.b.model.beside
        self.narrow = self.cuts.copy()
        self.narrow[0x80:] = self.narrow[0x1C:0x20] = False
        self._forget()

    def _forget(self) -> None:
        super()._forget()
        self.flat = np.zeros(0, np.int32)  # the units' links, as numbers of pairs
        self.sizes = np.zeros((0, 5), np.int32)  # whole, a, b, groups, links
        self.weights = np.zeros((0, 2), np.int64)  # sums of the links' counts and bests
        self.groups = pa.array([], pa.large_binary())
        self.pairs, self.pair_order = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _pair_numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair, in the order in which they were met."""
        unique, back = np.unique(keys, return_inverse=True)
        where = np.searchsorted(self.pairs, unique, sorter=self.pair_order)
        known = np.zeros(len(unique), bool)
        inside = where < len(self.pairs)
        known[inside] = self.pairs[self.pair_order[where[inside]]] == unique[inside]
        number = np.empty(len(unique), np.int64)
        number[known] = self.pair_order[where[known]]
        number[~known] = len(self.pairs) + np.arange((~known).sum())
        self.pairs = np.concatenate([self.pairs, unique[~known]])
        self.pair_order = np.argsort(self.pairs)
        return number[back]

    def _a_ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of units and each one's number of ids. Units that surely part from their neighbours are encoded as lines of LINE."""
        words = [raw[s:e].tobytes().decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        alone = ~(SPACE[raw[starts]] & ~SPACE[raw[ends - 1]])
        alone |= pc.match_substring_regex(pa.array(words, pa.large_string()), RARE_SPACE).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        some = int((~alone).sum())
        lines = ["".join(words[k] for k in order[x : min(x + LINE, some)].tolist()) for x in range(0, some, LINE)]
        got = [e.ids for e in self.a.encode_batch(lines + [words[k] for k in order[some:].tolist()], add_special_tokens=False)]
        ids = np.fromiter((i for x in got for i in x), np.int64)
        own_ends = np.cumsum((ends - starts)[order])
        n = np.diff(np.searchsorted(np.cumsum(self.a_bytes.n[ids]), own_ends, side="right"), prepend=0)
        before, back = np.cumsum(n) - n, np.empty_like(order)
        back[order] = np.arange(len(order))
        return ids[spread(before[back], n[back])], n[back]

    def _learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size, count = ends - starts, len(starts)
        a, n_a = self._a_ids(raw, starts, ends)
        data = raw[spread(starts, size)]
        b, bounds = self.b.encode(data, np.concatenate([[0], np.cumsum(size)]))
        b, n_b = b.astype(np.int64), np.diff(bounds)
        unit_a, unit_b = np.repeat(np.arange(count), n_a), np.repeat(np.arange(count), n_b)
        whole = np.ones(count, bool)
        for ids, unit, table in ((a, unit_a, self.a_bytes), (b, unit_b, self.b_bytes)):
            whole &= np.bincount(unit, table.n[ids], count).astype(np.int64) == size
        for ids, unit, table in ((a, unit_a, self.a_bytes), (b, unit_b, self.b_bytes)):
            kept_ids, kept_size = ids[whole[unit]], size[whole]
            unlike = np.flatnonzero(table.of(kept_ids) != raw[spread(starts[whole], kept_size)])
            bad = np.flatnonzero(whole)[np.unique(np.searchsorted(np.cumsum(kept_size), unlike, side="right"))]
            whole[bad] = False
        a, unit_a, b, unit_b = a[whole[unit_a]], unit_a[whole[unit_a]], b[whole[unit_b]], unit_b[whole[unit_b]]
        a_ends, b_ends = np.cumsum(self.a_bytes.n[a]), np.cumsum(self.b_bytes.n[b])
        cuts = np.union1d(a_ends, b_ends)  # each stretch between two cuts is the overlap of one a and one b
        x, y = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        root = components(len(a) + len(b), x, len(a) + y)
        group = np.cumsum(root[: len(a)] == np.arange(len(a))) - 1
        group_b = group[root[len(a) :]]
        order = np.argsort(np.concatenate([2 * group, 2 * group_b + 1]), kind="stable")
        side, unit = order >= len(a), np.concatenate([unit_a, unit_b])[order]
        both = np.concatenate([2 * group, 2 * group_b + 1])[order]
        last = np.append(both[1:] != both[:-1], True) if len(both) else np.zeros(0, bool)
        ending = np.where(last, np.where(side, 2, 1), 0)
        ending[np.append(unit[1:] != unit[:-1], True) if len(unit) else np.zeros(0, bool)] = 3
        signs = self.signs.take(pa.array(np.concatenate([a, b])[order] + ending * self.top))
        tokens = np.bincount(unit, minlength=count)
        text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(tokens)])), signs), pa.scalar(b"", pa.large_binary()))
        n = np.bincount(unit_a[x], minlength=count)
        groups = np.bincount(unit_a[root[: len(a)] == np.arange(len(a))], minlength=count)
        sizes = np.stack([whole, np.bincount(unit_a, minlength=count), np.bincount(unit_b, minlength=count), groups, n], 1)
        self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(n) - n).astype(np.int32)])
        self.n = np.concatenate([self.n, n.astype(np.int32)])
        pair = self._pair_numbers(a[x] << 32 | b[y]).astype(np.int32)
        self.flat = np.concatenate([self.flat, pair])
        self.sizes, self.groups = np.concatenate([self.sizes, sizes.astype(np.int32)]), pa.concat_arrays([self.groups, text])
        self.weights = np.concatenate([self.weights, self._weights(pair, n)])
        self._keep(keys)

    def _weights(self, pair: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros((len(n), 2), np.int64)
        if self.counts is not None and len(pair):
            known, *figures = self.counts
            where = np.searchsorted(known, self.pairs)
            for k, figure in enumerate(figures):
                total = np.concatenate([[0], np.cumsum(figure[where][pair], dtype=np.int64)])
                out[:, k] = total[np.cumsum(n)] - total[np.cumsum(n) - n]
        return out

    def weigh(self, counts: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> None:
        """From now on weights are by these counts and bests of pairs (their keys ascending), also those of units that are known; None: zero."""
        if self.counts is not counts:
            if counts is not None and not np.isin(self.pairs, counts[0]).all():
                self._forget()  # of another corpus
            self.counts = counts
            self.weights = self._weights(self.flat, self.n.astype(np.int64))

    def align(self, texts: pa.Array, groups: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array | None, np.ndarray, np.ndarray]:
        """Of each text its sizes and groups as text; of all texts the units' rows and numbers."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        raw, rows = utf8(texts)
        starts, ends, first = units(raw, rows, self.cuts)
        if (rare := pc.match_substring_regex(texts, RARE_SPACE).to_numpy(zero_copy_only=False)).any():
            fine, fine_ends, fine_first = units(raw, rows, self.narrow)
            narrow = np.repeat(rare, np.diff(first))
            starts = np.sort(np.concatenate([starts[~narrow], fine[np.repeat(rare, np.diff(fine_first))]]))
            ends, first = np.append(starts[1:], raw.size), np.searchsorted(starts, rows)
        if self.groups.nbytes > KEPT_BYTES:
            self._forget()
        found = self._numbers(raw, starts, ends)
        row = np.repeat(np.arange(len(rows) - 1), np.diff(first))
        figures = np.concatenate([self.sizes[found], self.weights[found]], axis=1)
        total = np.concatenate([np.zeros((1, 7), np.int64), np.cumsum(figures, axis=0, dtype=np.int64)])
        sizes = total[first[1:]] - total[first[:-1]]
        whole = sizes[:, 0] == np.diff(first)
        sizes[~whole] = 0
        text = None
        if groups:
            lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), self.groups.take(pa.array(found)))
            text = pc.if_else(pa.array(whole), pc.binary_join(lists, pa.scalar(b";", pa.large_binary())), pa.scalar(b"", pa.large_binary()))
        return sizes, whole, text, row[whole[row]], found[whole[row]]

    def doc_pairs(self, row: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct (row, pair) of units, and how many links each has."""
        n = self.n[found].astype(np.int64)
        pair = self.flat[spread(self.at[found], n)]
        key, times = np.unique(np.repeat(row, n) * len(self.pairs) + pair, return_counts=True)
        return key // max(1, len(self.pairs)), key % max(1, len(self.pairs)), times


def _counts(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        own.weigh(None)
        docs, pair = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            some = np.flatnonzero(docs)
            return pa.RecordBatch.from_pydict({"a": pa.array((pair[some] >> 32).astype(np.int32)), "b": pa.array((pair[some] & 0xFFFFFFFF).astype(np.int32)), "n": pa.array(docs[some])})

        for b in slices(batches):
            _, _, _, row, found = own.align(b.column("text"), groups=False)
            if len(own.pairs) < len(pair) or (own.pairs[: len(pair)] != pair).any():  # it has forgotten its units, and numbers pairs anew
                yield told()
                docs = np.zeros(0, np.int64)
            pair = own.pairs
            docs = np.concatenate([docs, np.zeros(len(pair) - len(docs), np.int64)])
            docs += np.bincount(own.doc_pairs(row, found)[1], minlength=len(docs))
        yield told()
        trim()

    return run


SIZES = "n_a long, n_b long, n_groups long, n_links long"


def _results(path_a: str, path_b: str, known=None):
    """With known counts a row for each document; without, also one for each of its distinct pairs, its other columns null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        own.weigh(known and known.value)
        row_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for b in slices(batches):
            sizes, _, text, row, found = own.align(b.column("text"))
            columns = {"doc_id": b.column("doc_id")} | {x.split()[0]: pa.array(sizes[:, k + 1]) for k, x in enumerate(SIZES.split(", "))}
            columns["groups"] = text.cast(pa.string())
            if known is not None:
                yield pa.RecordBatch.from_pydict(columns | {"n_best": pa.array(sizes[:, 6]), "count_sum": pa.array(sizes[:, 5])})
                continue
            ids = row_id + np.arange(len(b))
            row_id += len(b)
            yield pa.RecordBatch.from_pydict({"row": ids} | columns | {"a": np.full(len(b), -1, np.int32), "b": -1 - ids, "times": np.zeros(len(b), np.int64)})
            row, pair, times = own.doc_pairs(row, found)
            pair = own.pairs[pair]
            none = {k: pa.nulls(len(row), v.type) for k, v in columns.items()}
            yield pa.RecordBatch.from_pydict({"row": ids[row]} | none | {"a": (pair >> 32).astype(np.int32), "b": pair & 0xFFFFFFFF, "times": times})
        trim()

    return run


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """a, b, n and best: the linked id pairs, how many of docs' rows hold each, and whether no pair of the same a is held by more."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    counts = documents(docs).mapInArrow(_counts(path_a, path_b), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = settled(counts)
    return counts.join(counts.groupBy("a").agg(F.max("n").alias("most")), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, the numbers of tokens, groups and links, groups as text, and n_best and count_sum over the links of each row of docs(doc_id, text).

    A takes a space and the text, B the text. groups is `a1,a2|b1;a3|b2,b3`. A null or empty text, and one whose bytes a
    tokenizer doesn't give back (as one with U+2581), has no tokens: zeros and empty groups. Rows that repeat, or share
    an id, count each. An empty table gives none. Other columns of docs are left out, whatever their names. Texts are
    aligned whole; one without a place where both tokenizers surely cut is one unit. Up to broadcast_pairs pairs are
    broadcast with their counts, more are joined: the results are the same.
    """
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    spark, counts = docs.sparkSession, settled(pair_counts(docs, path_a, path_b))
    if counts.count() <= broadcast_pairs:
        got = counts.toArrow()
        pair = got["a"].to_numpy().astype(np.int64) << 32 | got["b"].to_numpy()
        order = np.argsort(pair)
        known = spark.sparkContext.broadcast((pair[order], got["n"].to_numpy()[order], got["best"].to_numpy()[order].astype(np.int8)))
        return documents(docs).mapInArrow(_results(path_a, path_b, known), f"doc_id long, {SIZES}, groups string, n_best long, count_sum long")
    rows = documents(docs).mapInArrow(_results(path_a, path_b), f"row long, doc_id long, {SIZES}, groups string, a int, b long, times long")
    rows = rows.join(counts.withColumn("b", F.col("b").cast("long")), ["a", "b"], "left")
    sums = [F.max(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")]
    sums += [F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).alias("n_best"), F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).alias("count_sum")]
    return rows.groupBy("row").agg(*sums).drop("row")
