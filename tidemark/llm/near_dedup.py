"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

The sketch has t coordinates filled in rounds. In round i every shingle draws a coordinate and a value; a coordinate
keeps the least (round, value) it was given. Rounds t to 2t-1 serve one coordinate each, so every coordinate is filled,
and a set is done at the end of the first round after which none is empty. Two sets agree at a coordinate with
probability equal to their Jaccard similarity, with the concentration of independent trials.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .sums import SCHEMA as SUMS
from .sums import blocks, summed, tasks_of
from .text import U, documents, fresh, hash_spans, mix, randoms, released, settled, slices, spans, utf8, windows

#: Bands of coordinates. At similarity 0.8 a pair shares no band with probability (1 - 0.8**6)**40 < 1e-5, at 0.85 < 1e-8.
BANDS, ROWS = 40, 6
#: Verifications that one task does against one hub.
FANOUT = 64
#: Counters that order shingles by frequency: 8 MB, whatever the data.
SLOTS = 1 << 20
FULL = np.iinfo(np.uint64).max


def shingles(raw: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    starts, ends, first = spans(raw, rows)
    words = hash_spans(raw, starts, ends, fold=True)
    hashes, _, at = windows(words, first, n)
    out = []
    for k in range(len(rows) - 1):
        if at[k + 1] > at[k]:
            out.append(np.unique(hashes[at[k] : at[k + 1]]))
        elif first[k + 1] > first[k]:
            some = words[first[k] : first[k + 1]]
            out.append(mix((some * randoms(len(some), 100 + len(some))).sum(keepdims=True, dtype=U)))
        else:
            out.append(np.zeros(0, U))
    return out


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of t coordinates for each set that isn't empty."""
    out = np.full((len(sets), t), FULL, U)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        drawn = mix(flat ^ U(0x9E3779B97F4A7C15 * (i + 1) & (2**64 - 1)))
        at = (drawn >> U(40)) % U(t) if i < t else np.full(len(drawn), i - t, U)
        value = (U(i) << U(54)) | (mix(drawn) >> U(10))
        np.minimum.at(out.reshape(-1), owner * t + at.astype(np.int64), value)
        todo = (out == FULL).any(1)[owner]
        if not todo.any():
            break
        flat, owner = flat[todo], owner[todo]
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each set and band; keys of different bands don't meet."""
    c = coordinates.reshape(len(coordinates), bands, rows)
    return mix((c * randoms(rows, 21)).sum(2, dtype=U) + randoms(bands, 22))


def digest_of(shingle_set: np.ndarray) -> bytes:
    return xxhash.xxh3_128(shingle_set.tobytes()).digest()


def _sketches(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingles(*utf8(b.column("text")), n)
            some = [k for k, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if some:
                for k, row in zip(some, band_keys(sketch([sets[k] for k in some], bands * rows), bands, rows), strict=True):
                    keys[k] = row.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_md5"), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_md5", "n_shingles", "digest", "keys"],
            )

    return run


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """node, root and shingle set of each row whose text is its class's."""
    for b in slices(batches):
        for node, root, digest, s in zip(b.column("node").to_pylist(), b.column("root").to_pylist(), b.column("digest").to_pylist(), shingles(*utf8(b.column("text")), n), strict=True):
            if digest_of(s) == digest:
                yield node, root, s


def _verified(n: int, percent: int):
    """Over the rows of one hub and a part of its partners: the partners that are linked to the hub."""

    def run(group: pa.Table) -> pa.Table:
        hub, base, found = group.column("root")[0].as_py(), None, []
        own = pa.compute.equal(group.column("node"), hub)
        for _, _, base in _sets(group.filter(own).to_batches(), n):
            break
        if base is not None:
            for node, _, s in _sets(group.filter(pa.compute.invert(own)).to_batches(), n):
                at = np.minimum(np.searchsorted(base, s), len(base) - 1)
                both = int((base[at] == s).sum())
                if 100 * both >= percent * (len(s) + len(base) - both):
                    found.append(node)
        return pa.table({"a": pa.array([hub] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return run


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (hub, node) whose full shingle sets are similar enough, as edges (a, b).

    A hub's pairs are dealt to groups of about FANOUT; its text goes to each of them.
    """
    fans = pairs.groupBy("hub").agg(F.ceil(F.count("*") / FANOUT).alias("parts"))
    members = pairs.join(fans, "hub").select(F.col("hub").alias("root"), F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), "node")
    hubs = fans.select(F.col("hub").alias("root"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("hub").alias("node"))
    return members.unionByName(hubs).join(texts, "node").groupBy("root", "part").applyInArrow(_verified(n, percent), "a long, b long")


def _tally(n: int):
    """Over texts: how many sets have a shingle in each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for _, _, s in _sets(batches, n):
            np.add.at(total, (s % U(SLOTS)).astype(np.int64), 1)
        yield blocks(total)

    return run


def _prefixes(n: int, percent: int, shared):
    """Over texts: of each set the rarest shingles, so many that two similar sets have one of them in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for node, root, s in _sets(batches, n):
            k = len(s) - -(-percent * len(s) // 100) + 1
            first = s[np.lexsort((s, counts[(s % U(SLOTS)).astype(np.int64)]))][:k]
            before = pa.array(np.roll(first, 1).view(np.int64), mask=np.arange(k) == 0)
            yield pa.RecordBatch.from_pydict({"node": np.full(k, node), "root": np.full(k, root), "shingle": first.view(np.int64), "before": before, "at": np.arange(k), "n": np.full(k, len(s))})

    return run


def rare_pairs(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Of texts(node, root, digest, text), the pairs (hub, node) of unlike roots that may be similar: an exact prefix filter.

    Shingles are ordered by how many sets have them (counted in SLOTS slots; any order gives whole results). Similar
    sets share one of their first shingles, and from the first shared one on, enough are left in both for the overlap.
    Of shared shingles that follow one another in both orders, only the first makes a pair.
    """
    spark = texts.sparkSession
    counts = summed(texts.mapInArrow(_tally(n), SUMS), SLOTS, tasks_of(texts))
    prefixes = settled(texts.mapInArrow(_prefixes(n, percent, spark.sparkContext.broadcast(counts)), "node long, root long, shingle long, before long, at long, n long"))
    mixed = prefixes.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("shingle")
    left = prefixes.join(mixed, "shingle")
    right = left.select("shingle", F.col("node").alias("hub"), F.col("root").alias("hub_root"), F.col("before").alias("hub_before"), F.col("at").alias("hub_at"), F.col("n").alias("hub_n"))
    enough = f"{100 + percent} * least(n - at, hub_n - hub_at) >= {percent} * (n + hub_n)"
    leads = "(before is null or hub_before is null or before <> hub_before)"  # else the shingle before has the pair
    return left.join(right, "shingle").where(f"hub < node and root <> hub_root and {enough} and {leads}").select("hub", "node").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, text_md5 and kept for every row of docs(doc_id, text).

    Words are lower-cased (A-Z); two documents are linked if 100 * |intersection| >= percent * |union| of their shingle
    sets. Documents with one and the same set form a class, which takes part once; a class keeps its smallest doc_id.
    Candidates are verified in three steps: each class against one hub, each against the smallest class of each of its
    buckets, and those whose buckets still hold several components against each other, as far as an exact prefix filter
    on their rarest shingles lets them pass. A step leaves out pairs that the steps before have joined to one
    component, so no link between components is lost; thousands of near copies of one text cost few pairs each,
    whether they are similar enough or not. Nothing is capped.

    Empty and null texts have 0 shingles and are components of their own. Repeated rows and repeated ids are rows of
    their own in the result. A null doc_id stays null and takes part like any other row.
    """
    docs = documents(docs)
    drawn = docs.withColumn("text_md5", F.unhex(F.md5("text"))).mapInArrow(_sketches(shingle, bands, rows), "doc_id long, text_md5 binary, n_shingles long, digest binary, keys array<long>")
    marks = settled(drawn.withColumn("row", F.monotonically_increasing_id()))
    classes = marks.where("digest is not null").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("n"))
    firsts = marks.join(classes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    spread = firsts.select("node", F.explode("keys").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = settled(spread.join(buckets, "key"))
    near = firsts.join(members.select("node").distinct(), "node").select("node", "digest", "doc_id", F.col("text_md5").alias("own_md5"))
    known = docs.withColumn("md5", F.unhex(F.md5("text")))  # rows without a doc_id are told apart by their texts
    texts = settled(near.join(known, (near.own_md5 == known.md5) & near.doc_id.eqNullSafe(known.doc_id)).select("node", "digest", "text"))
    if texts.count() > texts.select("node").distinct().count():  # repeated rows
        texts = settled(texts.dropDuplicates(["node"]))

    def links(pairs: DataFrame) -> DataFrame:
        return released(settled(verify(pairs.where("hub <> node").distinct(), texts, shingle, percent)))

    def rooted(roots: DataFrame) -> DataFrame:
        return members.join(roots, "node", "left").select("key", "node", "hub", F.coalesce("root", "node").alias("root"))

    edges = links(members.where("hub <> node").groupBy("node").agg(F.min("hub").alias("hub")))
    hop = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))  # enough to leave out most pairs that are joined
    further = hop.select(F.col("node").alias("root"), F.col("root").alias("next"))
    own = rooted(hop.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
    heads = own.where("node = hub").select("key", F.col("root").alias("hub_root"))
    edges = edges.unionByName(links(own.join(heads, "key").where("root <> hub_root").select("hub", "node")))
    own = released(settled(rooted(connected_components(edges))))
    mixed = own.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    unsure = own.join(mixed, "key").select("node", "root").distinct().join(texts, "node")
    edges = edges.unionByName(links(rare_pairs(settled(unsure), shingle, percent)))
    roots = released(settled(connected_components(edges)))
    named = classes.join(roots, "node", "left").select("digest", "least", "n", F.coalesce("root", "node").alias("root"), F.col("root").isNotNull().alias("linked"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    shared = named.where("n > 1 or linked").join(smallest, "root").select("digest", "component_id")
    return (
        marks.join(shared, "digest", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_md5")
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs(doc_id, text, ...) for each component, with all its columns.

    It is the one with the component's smallest doc_id; of rows that share that id, the one with the least digest of
    its text. Components of rows without a doc_id keep one row for each text. Every null or empty text stays, but for
    repeats of one id.
    """
    name = lambda c: (F.col(c).cast("long") if c == "doc_id" else F.unhex(F.md5(F.col("text").cast("string"))))
    marks = near_duplicates(docs, shingle, percent)
    alone = F.when(F.col("component_id").isNull(), F.col("text_md5"))
    kept = marks.where("kept or component_id is null").groupBy("component_id", alone.alias("alone")).agg(F.min(F.struct("doc_id", "text_md5")).alias("row"))
    rows = marks.groupBy("doc_id", "text_md5").agg(F.count("*").alias("n"))
    own_id, own_md5, n = (fresh(c, docs.columns) for c in ("own_id", "own_md5", "n_rows"))
    chosen = kept.select(F.col("row.doc_id").alias(own_id), F.col("row.text_md5").alias(own_md5))
    chosen = chosen.join(rows, chosen[own_id].eqNullSafe(rows["doc_id"]) & chosen[own_md5].eqNullSafe(rows["text_md5"])).select(own_id, own_md5, F.col("n").alias(n))
    found = docs.join(chosen, name("doc_id").eqNullSafe(F.col(own_id)) & name("text").eqNullSafe(F.col(own_md5)))
    once = found.where(F.col(n) == 1).select(docs.columns)
    return once.unionByName(found.where(F.col(n) > 1).dropDuplicates([own_id, own_md5]).select(docs.columns))
