"""Exact encoding and decoding with a merge-type sentence-piece model, by backtracking over longest matches.

Merging joins the adjacent pair of the best score, the leftmost of equals, until no pair makes a piece. A sequence of
pieces is what merging gives exactly if each two adjacent ones are what merging gives for their joined text. So a text
is encoded from its start: the longest piece that an Aho-Corasick automaton finds at a position is taken if it fits the
piece before it (found by merging the two again, and kept), else a shorter one; where none fits, the position is marked
in a bitfield as failed, never to be reached again, and the piece before it is taken back.

A task encodes each distinct unit once. A unit ends between two bytes that no piece holds side by side, as no merge
crosses such a place; of a usual vocabulary these are words with the spaces before them. A unit may be as long as a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .text import documents, hash_spans, kept, slices, trim, utf8
from .tokens import KEPT_WORDS, WordEncoder, vocabulary

SPACE_SIGN, UNKNOWN = "▁", -1
#: Characters that are matched at a time, pairs whose fit is kept, and ids that a worker keeps.
BLOCK, KEPT_PAIRS, KEPT_IDS = 1 << 12, 1 << 19, 1 << 23


class PieceModel:
    """A model's pieces, with U+2581 as a space; encode() and decode() work on text with the leading space in place."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        if model.normalize("ﬁ a  b ") != "▁ﬁ▁a▁▁b▁" or any(model.is_unused(i) for i in range(n)):
            raise ValueError("only models that leave text as it is, with a space put before it and no unused pieces, are encoded exactly")
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no piece for each byte")
        self.silent = np.array([model.is_control(i) for i in range(n)])
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.texts = [x.replace(SPACE_SIGN, " ") for x in names]
        self.scores = {self.texts[i]: model.get_score(i) for i in normal}
        self.ids = {self.texts[i]: i for i in normal}
        self.bytes = [x.encode() for x in self.texts]
        for value, i in self.byte_ids.items():
            self.bytes[i] = bytes([value])
        for i in np.flatnonzero(self.silent):
            self.bytes[i] = b""
        for i in range(n):
            if model.is_unknown(i):
                self.bytes[i] = model.decode([i]).encode()
        for c in sorted({c for x in self.scores for c in x} - set(self.ids)):  # characters inside pieces alone, beyond the ids
            self.ids[c] = len(self.texts)
            self.texts.append(c)
        self.longest = max(map(len, self.ids))
        self.near = {x[k : k + 2] for x in self.scores for k in range(len(x) - 1)}
        self.beside = np.zeros((256, 256), bool)
        for x in self.scores:
            b = np.frombuffer(x.encode(), np.uint8)
            self.beside[b[:-1], b[1:]] = True
        self.cuts = ~self.beside
        self.cuts[:, 0x80:0xC0] = False  # inside a character
        self.automaton = ahocorasick.Automaton()
        for x, i in self.ids.items():
            self.automaton.add_word(x, (len(x), i))
        self.automaton.make_automaton()
        self.fit: dict[tuple[int, int], bool] = {}

    def merged(self, text: str) -> list[str]:
        """What merging alone makes of a text; meant for short ones."""
        parts = list(text)
        while True:
            best, where = -np.inf, -1
            for k in range(len(parts) - 1):
                if (s := self.scores.get(parts[k] + parts[k + 1])) is not None and s > best:
                    best, where = s, k
            if where < 0:
                return parts
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves piece b after piece a."""
        known = self.fit.get((a, b))
        if known is None:
            if len(self.fit) >= KEPT_PAIRS:
                self.fit.clear()
            left, right = ("", "") if UNKNOWN in (a, b) else (self.texts[a], self.texts[b])
            known = self.fit[a, b] = left[-1:] + right[:1] not in self.near or self.merged(left + right) == [left, right]
        return known

    def _matches(self, text: str, block: int) -> list[list[tuple[int, int]]]:
        """For each position of a block of text, the pieces that begin there as (length, id), the longest last."""
        begin = block * BLOCK
        out: list[list[tuple[int, int]]] = [[] for _ in range(min(BLOCK, len(text) - begin))]
        for last, found in self.automaton.iter(text, begin, min(len(text), begin + BLOCK + self.longest)):
            if (at := last - found[0] + 1 - begin) < len(out):
                out[at].append(found)
        return [x or [(1, UNKNOWN)] for x in out]

    def encode(self, text: str) -> list[int]:
        """Ids of a text; characters that no piece holds become the ids of their bytes."""
        text = text.replace(SPACE_SIGN, " ")
        n, failed = len(text), bytearray(len(text) // 8 + 1)
        block, found = 0, self._matches(text, 0)
        ids: list[int] = []
        begun: list[tuple[int, int]] = []  # where each begins, and how many pieces there are left to try
        at, left = 0, -1
        while at < n:
            if at // BLOCK != block:
                block = at // BLOCK
                found = self._matches(text, block)
            options = found[at - block * BLOCK]
            left = len(options) if left < 0 else left
            while left:
                left -= 1
                length, i = options[left]
                end = at + length
                if not failed[end >> 3] >> (end & 7) & 1 and (not ids or self.fits(ids[-1], i)):
                    ids.append(i)
                    begun.append((at, left))
                    at, left = end, -1
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                ids.pop()
                at, left = begun.pop()
        if ids and (min(ids) < 0 or max(ids) >= len(self.bytes)):
            ends = [*(a for a, _ in begun[1:]), n]
            pairs = zip(ids, begun, ends, strict=True)
            ids = [j for i, (a, _), e in pairs for j in ([i] if 0 <= i < len(self.bytes) else [self.byte_ids[x] for x in text[a:e].encode()])]
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control ids are silent, the first piece's leading space goes, bytes that make no character are replaced one by one."""
        out, run, first = [], bytearray(), True
        for i in ids:
            if self.silent[i]:  # bytes on both sides of it make no character together
                out.append(repaired(bytes(run)))
                run.clear()
                continue
            run += self.bytes[i][1:] if first and self.texts[i][0] == " " else self.bytes[i]
            first = False
        return "".join([*out, repaired(bytes(run))])


def repaired(data: bytes) -> str:
    """data as text; each byte that is part of no character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def units(raw: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units that rows fall into, and each row's first unit (one more at the end)."""
    if not raw.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    begins = np.zeros(raw.size + 1, bool)
    begins[1:-1] = cuts[raw[:-1], raw[1:]]
    begins[rows] = True
    begins[-1] = False
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], raw.size), np.searchsorted(starts, rows)


class PieceEncoder(WordEncoder):
    """A worker's encoder: ids of units by their hash, each distinct one encoded once while it is kept."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        heads = [b[1:] if x[:1] == " " else b for b, x in zip(self.model.bytes, self.model.texts, strict=False)]
        self.pieces = pa.array(self.model.bytes + heads, pa.large_binary())  # each as it is, and as a text's first
        self._forget()

    def _learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        got = [self.model.encode(raw[a:b].tobytes().decode()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(n) - n).astype(np.int32)])
        self.n = np.concatenate([self.n, n.astype(np.int32)])
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in got for i in x), np.uint32)])
        self._keep(keys)

    def _numbers(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each unit's number, learnt first if it is new."""
        hashes = hash_spans(raw, starts, ends)
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, which = np.unique(hashes[new], return_index=True)
            if len(self.keys) + len(unique) > KEPT_WORDS or len(self.flat) > KEPT_IDS:
                self._forget()
                new = np.arange(len(hashes))
                unique, which = np.unique(hashes, return_index=True)
            which = new[which]
            self._learn(unique, raw, starts[which], ends[which])
            found[new] = self._find(hashes[new])
        return found

    def encode(self, raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each row's begin (one more at the end)."""
        starts, ends, first = units(raw, rows, self.model.cuts)
        found = self._numbers(raw, starts, ends)
        n = self.n[found]
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return self.flat[np.repeat(self.at[found] - total[:-1], n) + np.arange(total[-1])], total[first]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of rows of ids."""
        if self.model.silent[ids].any():
            return pa.array([self.model.decode(ids[a:b].tolist()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.large_string())
        ids = ids.copy()
        ids[bounds[:-1][bounds[:-1] < bounds[1:]]] += len(self.model.bytes)
        rows = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), self.pieces.take(pa.array(ids)))
        joined = pc.binary_join(rows, pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([repaired(x) for x in joined.to_pylist()], pa.large_string())


def spaced(texts: pa.Array) -> pa.Array:
    """Texts as the model sees them: with a space before, if they aren't empty. U+2581 and a space are the same to it."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.replace_substring(texts, SPACE_SIGN, " ")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))


def coder(path: str) -> PieceEncoder:
    return kept(f"pieces {path}", lambda: PieceEncoder(path))


def _round_trip(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for b in slices(batches):
            ids, bounds = own.encode(*utf8(spaced(b.column("text"))))
            rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            columns = {"doc_id": b.column("doc_id"), "ids": rows}
            if decode:
                columns["decoded"] = own.decode(ids.astype(np.int64), bounds).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)
        trim()

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for b in batches:
            lists = pc.fill_null(b.column("ids").cast(pa.large_list(pa.int64())), pa.scalar([], pa.large_list(pa.int64())))
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": own.decode(lists.flatten().to_numpy(), bounds).cast(pa.string())})
        trim()

    return run


def encoded(docs: DataFrame, path: str | None = None, decode: bool = False) -> DataFrame:
    """doc_id and ids of each row of docs(doc_id, text), exactly as the model's library gives them without begin and end.

    With decode, the column decoded holds the text that the ids stand for. A null or empty text has no ids and an empty
    decoded text. Rows that repeat, or share an id, are encoded each; an empty table gives none. Other columns of docs
    are left out, whatever their names. Texts of any length are encoded whole; a text of no cut at all is one unit, whose
    matches are looked up in blocks.
    """
    path = path or vocabulary("piece_bpe_32k.model")
    return documents(docs).mapInArrow(_round_trip(path, decode), "doc_id long, ids array<int>" + (", decoded string" if decode else ""))


def decoded(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each row of coded(doc_id, ids), whatever ids these are; null ids give an empty text."""
    path = path or vocabulary("piece_bpe_32k.model")
    return coded.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids").mapInArrow(_decode(path), "doc_id long, text string")
