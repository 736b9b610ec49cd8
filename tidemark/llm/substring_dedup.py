"""Repeated passages across documents: an FM-index per shard of the text, and every document streamed through it.

A shard holds text by content, not by document: each run of `length` words (a window) belongs to the shard of its
anchor, the least hash among its six-word sequences. So equal windows meet in one shard, whichever documents hold
them, and each document is searched in the shards of its own anchors instead of in all. Only anchors that stand in
two texts can belong to a repeated window; the others need no index. In a shard, the stretches of text around one
anchor are indexed once each, with the smallest doc_id that has them, and all are streamed through the index backwards:
the matching statistics reach `length` words at every window, and the class reached names the smallest document with it.

Documents are handled in groups, about one to a partition. What leaves a group for a shard is each anchor, or each
stretch, once: a passage that a third of all documents share is one entry for each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .text import U, documents, hash_spans, mix, partitions, powers, slices, spans, trim, utf8, windows

LENGTH, ANCHOR = 13, 6
#: Windows in one stretch at most; indexes that a shard is cut into, one built after another.
STRETCH, INNER = 64, 4
LOW = U(0xFFFFFFFF)


def anchors(words: np.ndarray, first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one anchor: key, row, first window's first word, number of windows."""
    grams, at, firsts = windows(words, first, ANCHOR)
    w = length - ANCHOR + 1
    if len(grams) < w:
        return np.zeros(0, U), *(np.zeros(0, np.int64),) * 3
    least, have = grams, 1
    while have < w:
        step = min(have, w - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    n = np.maximum(np.diff(firsts) - (w - 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    here = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(firsts[:-1], n)
    keys, start = mix(least[here]), at[here]
    if not len(keys):
        return keys, row, start, start
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    begin = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    new |= (np.arange(len(keys)) - begin) % STRETCH == 0
    k = np.flatnonzero(new)
    return keys[k], row[k], start[k], np.diff(k, append=len(keys))


def hash_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of words."""
    up, down = powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(words * up[: len(words)], dtype=U)])
    return mix((sums[starts + sizes] - sums[starts]) * down[starts] + sizes.astype(U))


def _parts(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by shard and index, the shards that are there, and where each begins (one more at the end)."""
    shard = (keys % U(shards)).astype(np.int64)
    order = np.lexsort((_inner(keys, shards), shard))
    found, begin = np.unique(shard[order], return_index=True)
    return order, found, np.append(begin, len(order))


def _inner(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys // U(shards) % U(INNER)).astype(np.uint8)


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _joined(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of arrays, and of which row each is."""
    parts = [np.frombuffer(x.as_py(), kind) for x in column]
    return np.concatenate([np.zeros(0, kind), *parts]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _copies(docs: pa.Table, copies: pa.Table) -> np.ndarray:
    """Which of a group's documents are whole copies, by both of their hashes."""
    kind = np.dtype([("rid", np.int64), ("check", np.int64)])
    copies = copies.filter(copies.column("check").is_valid())
    both = []
    for table in (docs, copies):
        out = np.empty(table.num_rows, kind)
        for c in kind.names:
            out[c] = table.column(c).to_numpy()
        both.append(out)
    return np.isin(*both)


def _texts(group: pa.Table, copies: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch, np.ndarray]]:
    """Word hashes, first words and doc_ids of a group's documents that aren't copies, in slices of bounded size."""
    keep = ~_copies(group, copies)
    keep &= group.column("doc_id").is_valid().to_numpy()
    for b in slices(group.filter(pa.array(keep)).combine_chunks().to_batches()):
        raw, rows = utf8(b.column("text"))
        starts, ends, first = spans(raw, rows)
        yield hash_spans(raw, starts, ends), first, b.column("doc_id").to_numpy(), b, (starts, ends, raw)


def _send_anchors(shards: int, length: int):
    def run(docs: pa.Table, copies: pa.Table) -> pa.Table:
        keys, rids = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for words, first, _, b, _ in _texts(docs, copies):
            k, row, _, _ = anchors(words, first, length)
            keys.append(k)
            rids.append(b.column("rid").to_numpy()[row])
        keys, rids = np.concatenate(keys), np.concatenate(rids)
        if not len(keys):
            return pa.table({"p": pa.array([], pa.int32()), "q": pa.array([], pa.int32()), "keys": pa.array([], pa.binary()), "twice": pa.array([], pa.binary())})
        order = np.argsort(keys, kind="stable")
        keys, rids = keys[order], rids[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        twice = np.minimum.reduceat(rids, at) != np.maximum.reduceat(rids, at)
        keys = keys[at]
        order, found, begin = _parts(keys, shards)
        short, twice = (keys[order] >> U(32)).astype(np.uint32), twice[order]
        cut = list(zip(begin[:-1], begin[1:], strict=True))
        return pa.table({"p": pa.array(found, pa.int32()), "q": pa.array([docs.column("q")[0].as_py()] * len(found), pa.int32()), "keys": _binary([short[a:b] for a, b in cut]), "twice": _binary([np.packbits(twice[a:b]) for a, b in cut])})

    return run


def _repeated(group: pa.Table) -> pa.Table:
    """Of one shard's anchors those that stand in two texts, back to each group that has them."""
    keys, row = _joined(group.column("keys"), np.uint32)
    sizes = np.bincount(row, minlength=group.num_rows)
    twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n) for x, n in zip(group.column("twice"), sizes.tolist(), strict=True)]).astype(bool)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    at = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    many = (np.diff(at, append=len(s)) > 1) | np.maximum.reduceat(twice[order], at)
    hit = np.empty(len(s), bool)
    hit[order] = np.repeat(many, np.diff(at, append=len(s)))
    keys, row = keys[hit], row[hit]
    some = np.unique(row)
    cut = np.searchsorted(row, np.append(some, group.num_rows))
    return pa.table({"q": group.column("q").combine_chunks().take(pa.array(some)), "p": pa.array([group.column("p")[0].as_py()] * len(some), pa.int32()), "keys": _binary([keys[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])})


def _send_stretches(shards: int, length: int):
    def run(docs: pa.Table, marked: pa.Table) -> pa.Table:
        copies = marked
        marked = marked.filter(marked.column("p").is_valid())
        short, which = _joined(marked.column("keys"), np.uint32)
        wanted = np.sort((marked.column("p").to_numpy().astype(np.int64)[which] << 32) | short)
        out: dict[str, list] = {c: [] for c in ("p", "inner", "words", "codes", "sizes", "least", "most")}
        held: list[tuple] = []
        if len(wanted):
            for words, first, doc_ids, _, _ in _texts(docs, copies):
                keys, row, start, n = anchors(words, first, length)
                code = ((keys % U(shards)).astype(np.int64) << 32) | (keys >> U(32)).astype(np.int64)
                hit = wanted[np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)] == code
                keys, row, start, n = keys[hit], row[hit], start[hit], n[hit] + length - 1
                hashes, d = hash_runs(words, start, n), doc_ids[row]
                order = np.lexsort((d, hashes))
                hashes, d = hashes[order], d[order]
                at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool))
                last = np.append(at[1:], len(hashes)) - 1
                one = order[at]
                own = np.repeat(start[one] - np.cumsum(n[one]) + n[one], n[one]) + np.arange(n[one].sum())
                held.append((hashes[at], keys[one], n[one], d[at], d[last], words[own]))
        if held:
            hashes, keys, n, least, most = (np.concatenate([h[k] for h in held]) for k in range(5))
            words = np.concatenate([h[5] for h in held])
            begin = np.cumsum(n) - n
            order = np.argsort(hashes, kind="stable")
            at = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1]) if len(order) else np.zeros(0, bool))
            one = order[at]
            if len(one):
                least, most = np.minimum.reduceat(least[order], at), np.maximum.reduceat(most[order], at)
            keys, n, begin = keys[one], n[one], begin[one]
            order, found, cut = _parts(keys, shards)
            for p, a, b in zip(found.tolist(), cut[:-1], cut[1:], strict=True):
                k = order[a:b]
                mine = words[np.repeat(begin[k] - np.cumsum(n[k]) + n[k], n[k]) + np.arange(n[k].sum())]
                known, codes = np.unique(mine, return_inverse=True)
                out["p"].append(p)
                out["inner"].append(_inner(keys[k], shards))
                out["words"].append(known)
                out["codes"].append(codes.astype(np.uint16 if len(known) <= 1 << 16 else np.uint32))
                out["sizes"].append(n[k].astype(np.uint16))
                out["least"].append(least[k])
                out["most"].append(most[k])
        q = docs.column("q")[0].as_py() if docs.num_rows else 0
        return pa.table({"p": pa.array(out["p"], pa.int32()), "q": pa.array([q] * len(out["p"]), pa.int32()), **{c: _binary(out[c]) for c in ("inner", "words", "codes", "sizes", "least", "most")}})

    return run


def _intervals(words: np.ndarray, sizes: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Builds an index over the distinct stretches, streams all through it, and reports what smaller documents have.

    The arrays name the stretch, its hash, and an interval of its windows with the smallest document that has them.
    """
    begin = np.cumsum(sizes) - sizes
    hashes = hash_runs(words, begin, sizes)
    distinct, one, back = np.unique(hashes, return_index=True, return_inverse=True)
    n = sizes[one]
    known, symbols = np.unique(words[np.repeat(begin[one] - np.cumsum(n) + n, n) + np.arange(n.sum())], return_inverse=True)
    smallest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(smallest, back, least)
    index = FMIndex(symbols, n, len(known), length)
    lowest = np.minimum.reduceat(smallest[index.owner], index.class_starts)
    sequence, window, found = index.matching_classes()
    order = np.lexsort((window, sequence))
    sequence, window, doc = sequence[order], window[order], lowest[found[order]]
    new = np.ones(len(doc), bool)
    new[1:] = (sequence[1:] != sequence[:-1]) | (doc[1:] != doc[:-1])
    k = np.flatnonzero(new)
    count = np.diff(k, append=len(doc))
    sequence, window, doc = sequence[k], window[k], doc[k]
    first = np.searchsorted(sequence, np.arange(len(distinct) + 1))
    each = np.diff(first)[back]  # every entry gets its stretch's intervals
    at = np.repeat(first[back] - np.cumsum(each) + each, each) + np.arange(each.sum())
    entry = np.repeat(np.arange(len(back)), each)
    use = doc[at] < most[entry]
    at, entry = at[use], entry[use]
    return entry, hashes[entry], window[at].astype(np.uint16), count[at].astype(np.uint16), doc[at]


def _search(length: int):
    def run(group: pa.Table) -> pa.Table:
        """One shard, its indexes one after another."""
        inner, row = _joined(group.column("inner"), np.uint8)
        sizes = _joined(group.column("sizes"), np.uint16)[0].astype(np.int64)
        least, most = _joined(group.column("least"), np.int64)[0], _joined(group.column("most"), np.int64)[0]
        parts = []
        for known, codes in zip(group.column("words"), group.column("codes"), strict=True):
            known, codes = np.frombuffer(known.as_py(), U), codes.as_py()
            parts.append(known[np.frombuffer(codes, np.uint16 if len(known) <= 1 << 16 else np.uint32)])
        words, of = np.concatenate(parts), np.repeat(inner, sizes)
        del parts
        found = []
        for k in range(INNER):
            mine = np.flatnonzero(inner == k)
            if len(mine):
                entry, *rest = _intervals(words[of == k], sizes[mine], least[mine], most[mine], length)
                found.append((row[mine[entry]], *rest))
        to, *rest = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(to, kind="stable")
        to = to[order]
        some = np.unique(to)
        cut = np.searchsorted(to, np.append(some, group.num_rows))
        columns = [_binary([x[order[a:b]] for a, b in zip(cut[:-1], cut[1:], strict=True)]) for x in rest]
        trim()
        return pa.table([group.column("q").combine_chunks().take(pa.array(some)), *columns], ["q", "stretch", "window", "count", "doc"])

    return run


def _remove(length: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        whole = _copies(docs, found)
        found = found.filter(found.column("stretch").is_valid())
        stretch, window, count, doc = (_joined(found.column(c), k)[0] for c, k in (("stretch", U), ("window", np.uint16), ("count", np.uint16), ("doc", np.int64)))
        order = np.argsort(stretch, kind="stable")
        stretch, window, count, doc = stretch[order], window[order].astype(np.int64), count[order].astype(np.int64), doc[order]
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": []}
        docs = docs.append_column("copied", pa.array(whole))
        for b in slices(docs.combine_chunks().to_batches()):
            raw, rows = utf8(b.column("text"))
            starts, ends, first = spans(raw, rows)
            total, valid = np.diff(first), b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            copied = b.column("copied").to_numpy(zero_copy_only=False) & valid
            gone = np.zeros(len(starts) + 1, np.int64)
            if len(stretch):
                words = hash_spans(raw, starts, ends)
                _, row, at, n = anchors(words, first, length)
                hashes = hash_runs(words, at, n + length - 1)
                low, high = np.searchsorted(stretch, hashes), np.searchsorted(stretch, hashes, side="right")
                m = high - low
                which = np.repeat(np.arange(len(m)), m)
                k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(low, m)
                ids = np.where(valid, b.column("doc_id").fill_null(0).to_numpy(), np.iinfo(np.int64).min)
                use = doc[k] < ids[row[which]]
                which, k = which[use], k[use]
                begin = at[which] + window[k]
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + count[k] + length - 1, -1)
            gone = np.cumsum(gone[:-1]) > 0
            gone |= np.repeat(copied & (total >= length), total)
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(first[:-1], len(gone))) * (total > 0)
            data = raw.tobytes()
            for k in range(b.num_rows):
                kept = data[rows[k] : rows[k + 1]].split()
                if removed[k]:
                    kept = [w for w, g in zip(kept, gone[first[k] : first[k + 1]].tolist(), strict=True) if not g]
                kept = b" ".join(kept)
                out["kept_sha256"].append(sha256(kept).hexdigest())
            out["doc_id"] += b.column("doc_id").to_pylist()
            out["n_words"].append(total)
            out["n_removed"].append(removed)
        flat = lambda c: np.concatenate([np.zeros(0, np.int64), *out[c]])
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": flat("n_words"), "n_removed": flat("n_removed"), "kept_sha256": pa.array(out["kept_sha256"], pa.string())})

    return run


def repeated_passages(docs: DataFrame, length: int = LENGTH, shards: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every row of docs(doc_id, text).

    A word goes if a run of `length` words over it also stands in a document with a smaller doc_id. kept_sha256 is of
    the words that stay, joined by one space. Words are compared as they are.

    Texts that repeat whole are found by digest: all but those of the smallest doc_id lose every word, if they have
    `length`. Rows that share a doc_id don't remove each other's words. A row without a doc_id removes nothing and loses
    nothing. Null and empty texts have no words.
    """
    spark = docs.sparkSession
    shards = shards or partitions(spark)
    hashed = lambda: documents(docs).withColumns({"rid": F.xxhash64("doc_id", "text"), "check": F.xxhash64(F.lit(23), "text")})
    base = hashed().withColumn("q", F.pmod("rid", F.lit(shards)).cast("int")).select("q", "doc_id", "text", "rid", "check")
    marks = hashed().where("doc_id is not null and length(text) > 0").select("doc_id", "rid", "check", F.unhex(F.md5("text")).alias("digest"), F.pmod("rid", F.lit(shards)).cast("int").alias("q"))
    parts = marks.groupBy("digest", "q").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))  # so that no digest is one task's
    heads = parts.groupBy("digest").agg(F.min("least").alias("head"), F.max("most").alias("most")).where("most > head").drop("most")
    named = parts.select("digest", "q").join(heads, "digest")
    copies = marks.join(named, ["digest", "q"]).where("doc_id > head").select("q", "rid", "check").distinct()
    texts = base.groupBy("q")
    sent = texts.cogroup(copies.groupBy("q")).applyInArrow(_send_anchors(shards, length), "p int, q int, keys binary, twice binary")
    repeated = sent.groupBy("p").applyInArrow(_repeated, "q int, p int, keys binary")
    marked = repeated.unionByName(copies, allowMissingColumns=True).groupBy("q")
    stretches = texts.cogroup(marked).applyInArrow(_send_stretches(shards, length), "p int, q int, inner binary, words binary, codes binary, sizes binary, least binary, most binary")
    found = stretches.groupBy("p").applyInArrow(_search(length), "q int, stretch binary, window binary, count binary, doc binary")
    return texts.cogroup(found.unionByName(copies, allowMissingColumns=True).groupBy("q")).applyInArrow(_remove(length), "doc_id long, n_words long, n_removed long, kept_sha256 string")
