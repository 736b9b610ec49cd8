"""Benchmark passages in training text, found by spaced seeds and verified position by position.

A mask is laid over every run of words; the words under its ones are hashed, those under its zeros ignored. The two
masks find every stretch of 13 words of which at most two were substituted. Items of fewer words have masks of their
own length that part their words among them, one more than the substitutions allowed, so one mask stays unharmed. The
seeds of documents and of items are joined; a hit names a document, an item and their offset, and the overlap at that
offset is then compared word by word. Of seeds that follow one another at one offset only the first makes a hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import U, documents, fresh, hash_spans, mix, randoms, settled, slices, spans, utf8

#: Any 13 words with two substitutions contain one of these masks unharmed.
MASKS = ("11101011", "11001111")
WINDOW, SHARE = 13, 80
#: Items of fewer words than this must stand in a document word for word.
TOLERANT = 6
#: Bits of the filter for each of the items' seeds, how many it has at most (16 MB), bits in one of its blocks, and probes.
FILTER_BITS, FILTER_MOST, FILTER_BLOCK, PROBES = 64, 1 << 27, 1 << 18, 4
#: Texts that overlap are told to all tasks up to this number (16 bytes each); more are joined.
BROADCAST_TEXTS = 1 << 20


def needed(n: int) -> int:
    """How many words of a window of n must be equal."""
    return -(-SHARE * n // 100) if n >= TOLERANT else n


def families(lengths: list[int]) -> list[tuple[int, np.ndarray, int]]:
    """Number, places under the mask, and words of the items (WINDOW: as many or more) of each mask that these items need."""
    out = []
    for n in sorted({min(n, WINDOW) for n in lengths}):
        if n == WINDOW:
            out += [(k, np.flatnonzero([c == "1" for c in m]), n) for k, m in enumerate(MASKS)]
        else:
            parts = n - needed(n) + 1
            out += [(100 * n + r, np.arange(r, n, parts), n) for r in range(parts)]
    return out


def seeds(words: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """A hash of the words under the mask at each place where it fits."""
    n = max(0, len(words) - int(mask[-1]))
    total = np.zeros(n, U)
    for c, j in zip(randoms(len(mask), 41 + k), mask.tolist(), strict=True):
        total += words[j : j + n] * c
    return mix(total)


def probes(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    step = mix(keys + U(7)) | U(1)
    return [((keys + U(i) * step) % U(bits)).astype(np.int64) for i in range(PROBES)]


def passing(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the keys that the filter may hold."""
    at = np.arange(len(keys))
    step = mix(keys + U(7)) | U(1)
    for i in range(PROBES):
        place = ((keys[at] + U(i) * step[at]) % U(8 * len(bits))).astype(np.int64)
        at = at[(bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]
    return at


def placed(words: np.ndarray, first: np.ndarray, family: tuple[int, np.ndarray, int], rows: np.ndarray, bits: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """Row, seed, the seed one word before (null at a row's start), and places of each group of like seeds of one family.

    rows tells which rows to look at; bits is the filter that seeds must pass.
    """
    k, mask, _ = family
    drawn = seeds(words, mask, k)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here = np.arange(len(drawn)) if bits is None else passing(drawn, bits)
    here = here[rows[row[here]] & (row[here] == row[here + int(mask[-1])])]
    starts = here == first[row[here]]
    before = np.where(starts, U(0), drawn[here - 1])
    order = np.lexsort((here, before, starts, drawn[here], row[here]))
    here, before, starts = here[order], before[order], starts[order]
    seed, own = drawn[here], row[here]
    new = np.ones(len(here), bool)
    new[1:] = (own[1:] != own[:-1]) | (seed[1:] != seed[:-1]) | (before[1:] != before[:-1]) | (starts[1:] != starts[:-1])
    at = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.append(at, len(here)), pa.int32()), pa.array(here - first[own], pa.int32()))
    return own[at], pa.array(seed[at].view(np.int64)), pa.array(before[at].view(np.int64), mask=starts[at]), places


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lower-cased (A-Z), and each row's first one."""
    raw, rows = utf8(column)
    starts, ends, first = spans(raw, rows)
    return hash_spans(raw, starts, ends, fold=True), first


def _rows(words: np.ndarray, first: np.ndarray, which: np.ndarray) -> pa.Array:
    return pa.array([words[first[r] : first[r + 1]].tobytes() for r in which.tolist()], pa.binary())


ITEMS = "item long, item_id long, words binary, n long"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        words, first = _words(b.column("text"))
        some = np.flatnonzero(np.diff(first))
        take = lambda c: b.column(c).take(pa.array(some))
        yield pa.RecordBatch.from_arrays([take("item"), take("item_id"), _rows(words, first, some), pa.array(np.diff(first)[some], pa.int64())], ["item", "item_id", "words", "n"])


SEEDS = "item long, seed long, item_before long, item_at array<int>"


def _item_seeds(all_families: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.frombuffer(x.as_py(), U) for x in b.column("words")]
            words, first = np.concatenate([np.zeros(0, U), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
            for family in all_families:
                own, seed, before, at = placed(words, first, family, np.minimum(np.diff(first), WINDOW) == family[2])
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(own)), seed, before, at], ["item", "seed", "item_before", "item_at"])

    return run


def _filter_block(size: int):
    def run(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        bits = np.zeros(min(size, FILTER_BLOCK), bool)
        bits[group.column("place").to_numpy() % FILTER_BLOCK] = True
        return pa.table({"block": pa.array([block], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    return run


def _filter_places(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = np.unique(np.concatenate(probes(b.column("seed").to_numpy().view(U), size)))
            yield pa.RecordBatch.from_pydict({"block": place // FILTER_BLOCK, "place": place})

    return run


def seed_filter(found: DataFrame) -> np.ndarray:
    """The bytes of a Bloom filter of found(seed): PROBES bits for each, made by block; at most FILTER_MOST bits, whatever the items."""
    n = found.count()
    size = min(FILTER_MOST, max(1 << 10, 1 << (FILTER_BITS * n).bit_length()))
    blocks = found.select("seed").mapInArrow(_filter_places(size), "block long, place long").distinct().groupBy("block").applyInArrow(_filter_block(size), "block long, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for r in blocks.collect():
        own = np.frombuffer(r["bits"], np.uint8)
        out[r["block"] * (FILTER_BLOCK // 8) : r["block"] * (FILTER_BLOCK // 8) + len(own)] = own
    return out


HITS = "text_md5 binary, doc_id long, words binary, seed long, before long, at array<int>"


def _hits(all_families: list, shared):
    """Of texts that a seed of an item may be in: a row with all words, and one for each group of like seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, names = shared.value, [x.split()[0] for x in HITS.split(", ")]
        for b in slices(batches):
            words, first = _words(b.column("text"))
            rows, met = np.ones(b.num_rows, bool), np.zeros(b.num_rows, bool)
            nothing = lambda n, kind: pa.nulls(n, kind)
            for family in all_families:
                own, seed, before, at = placed(words, first, family, rows, bits)
                met[own] = True
                if len(own):
                    yield pa.RecordBatch.from_arrays([b.column("text_md5").take(pa.array(own)), nothing(len(own), pa.int64()), nothing(len(own), pa.binary()), seed, before, at], names)
            some = np.flatnonzero(met)
            if len(some):
                take = lambda c: b.column(c).take(pa.array(some))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([take("text_md5"), take("doc_id"), _rows(words, first, some), nothing(len(some), pa.int64()), nothing(len(some), pa.int64()), nothing(len(some), pa.list_(pa.int32()))], names)

    return run


def compared(words: np.ndarray, item: np.ndarray, offset: int) -> list[tuple[int, int, int, int]]:
    """Start in the document, start in the item, words and equal words of each overlap at one offset of the item."""
    n, a, b = len(item), max(0, offset), min(len(words), offset + len(item))
    width = min(WINDOW, n)
    equal = np.zeros(n, np.int64)
    equal[a - offset : b - offset] = words[a:b] == item[a - offset : b - offset]
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[width:] - total[:-width] >= needed(width))
    out = []
    for run in np.split(good, np.flatnonzero(np.diff(good) > width) + 1) if len(good) else []:
        s, e = int(run[0]), int(run[-1]) + width
        hits = np.flatnonzero(equal[s:e])
        s, e = s + int(hits[0]), s + int(hits[-1]) + 1
        out.append((offset + s, s, e - s, int(total[e] - total[s])))
    return out


FOUND = "text_md5 binary, item_id long, doc_start long, item_start long, n_words long, n_equal long, item_words long"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), *[pa.int64()] * 6]
    names = [x.split()[0] for x in FOUND.split(", ")]
    for b in batches:
        out = []
        for r in range(b.num_rows):
            words, item = (np.frombuffer(b.column(c)[r].as_py(), U) for c in ("words", "item_words"))
            offsets = np.zeros(len(words) + len(item), bool)  # by offset + the item's length
            for pair in b.column("pairs")[r].as_py():
                at, others = np.array(pair["at"]), pair["item_at"]
                if len(others) > len(at):
                    at, others = np.array(others), at.tolist()
                    for x in others:
                        offsets[x - at + len(item)] = True
                else:
                    for x in others:
                        offsets[at - x + len(item)] = True
            key, item_id = b.column("text_md5")[r].as_py(), b.column("item_id")[r].as_py()
            for offset in (np.flatnonzero(offsets) - len(item)).tolist():
                out += [(key, item_id, *o, len(item)) for o in compared(words, item, offset)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _md5() -> F.Column:
    return F.unhex(F.md5(F.col("text").cast("string")))


def found_in(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overlaps by text_md5 of the texts of docs(doc_id, text), and text_md5 and doc_id of the rows that they may be in."""
    spark = docs.sparkSession
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("length(text) > 0").withColumn("item", F.monotonically_increasing_id())
    items = settled(named.select("item", "item_id", "text").mapInArrow(_items, ITEMS))
    lengths = [r["n"] for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()]
    if not lengths:
        return spark.createDataFrame([], FOUND), spark.createDataFrame([], "text_md5 binary, doc_id long")
    needs = families(lengths)
    own = settled(items.select("item", "words").mapInArrow(_item_seeds(needs), SEEDS))
    shared = spark.sparkContext.broadcast(seed_filter(own))
    hits = settled(documents(docs).select("doc_id", "text", _md5().alias("text_md5")).mapInArrow(_hits(needs, shared), HITS))
    shared.destroy()
    marks = hits.where("seed is not null").select("text_md5", "seed", "before", "at").dropDuplicates(["text_md5", "seed", "before"])
    first = "before is null or item_before is null or before <> item_before"  # else the seeds one word before have the hit
    pairs = marks.join(own, "seed").where(first).groupBy("text_md5", "item").agg(F.collect_list(F.struct("at", "item_at")).alias("pairs"))
    texts = hits.where("words is not null")
    whole = pairs.join(texts.groupBy("text_md5").agg(F.first("words").alias("words")), "text_md5").join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    return whole.mapInArrow(_verified, FOUND), texts.select("text_md5", "doc_id")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every overlap of docs(doc_id, text) with benchmark(item_id, text), in words: where, how long, how many equal.

    An overlap is a union of runs of 13 words at one offset that agree in at least 80 %; its ends are equal words. Of
    items of 6 to 12 words, 80 % of all words must agree; shorter ones are found word for word. Words are lower-cased
    (A-Z). Items without words are in nothing, those without an item_id are looked for like others, and repeated items
    are one each. A document without words, or without an overlap, gives no row; repeated rows, and rows without a
    doc_id, give theirs each. Texts of any length are read whole; equal texts are compared once.

    A filter of the items' seeds, of at most 16 MB, is sent to the workers; it may let a seed pass that no item has,
    never the other way. All else is joined by seed, by text and by item.
    """
    found, rows = found_in(docs, benchmark)
    return rows.join(found, "text_md5").select("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal", "item_words")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs(text, ...) that overlap with no item, with all their columns.

    Rows are judged one by one, so those with a null or empty text, or no doc_id, stay; equal texts have one fate.
    """
    gone = settled(found_in(docs.select(F.lit(None).alias("doc_id"), "text"), benchmark)[0].select("text_md5").distinct())
    own = fresh("own_md5", docs.columns)
    gone = gone.withColumnRenamed("text_md5", own)
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_TEXTS else gone
    return docs.withColumn(own, _md5()).join(gone, own, "left_anti").select(docs.columns)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that overlap: the longest overlap, and the share of the item that it covers.

    Documents without an overlap give none. Rows with one doc_id are one document here, as are all rows without one;
    items likewise by item_id.
    """
    found = overlaps(docs, benchmark)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", "n_equal", F.negative("doc_start").alias("before"), "item_words")).alias("b"), F.count("*").alias("n_overlaps"))
    item_words = F.col("b.item_words")
    return best.select("doc_id", "item_id", "n_overlaps", F.negative("b.before").alias("doc_start"), "b.n_words", "b.n_equal", item_words.alias("item_words"), (F.col("b.n_words") / item_words).alias("covered"))
