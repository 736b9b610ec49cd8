"""Token ids of whole texts, from a public tokenizer whose units never cross white space.

Such a tokenizer gives a text the ids of its white-space separated words, one after another. A word is parted
further where its pattern always ends one match and begins another, and parts in ASCII are lower-cased, as the tokenizer
does itself.
So a task encodes each distinct part once, with the tokenizers library, and looks all others up by their hash, in a table
that is half empty at least; of two parts with one slot the later takes the next that is free. New parts are encoded as
lines of LINE parts, and the ids dealt to them by the offsets at which they begin.
"""

from __future__ import annotations

import os

import numpy as np

from .text import SPACE, U, hash_spans, kept, spans

#: The id that ends each document.
END = 1
#: Parts that a worker keeps at most; beyond, it forgets them all and starts anew.
KEPT_WORDS = 1 << 20
SLOTS = 21
LINE = 64

BAR = ord("|")  # the sign that the special tokens' strings hold
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_letter = (LOWER >= 97) & (LOWER <= 122)
#: 0 for white space, 1 letters, 2 digits, 3 other signs, 4 for bytes beyond ASCII, 7 the apostrophe, which may take letters with it.
SORT = np.select([SPACE, _letter, (LOWER >= 48) & (LOWER <= 57), LOWER > 127, LOWER == ord("'")], [0, 1, 2, 4, 7], 3).astype(np.uint8)
#: By the sorts of two bytes side by side, the first one's times 8: whether a match always ends between them.
APART = np.zeros(64, bool)
APART[[8 * a + b for a, b in ((1, 2), (1, 3), (1, 7), (2, 1), (2, 2), (2, 3), (2, 7), (3, 1), (3, 2), (7, 2))]] = True


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def parts(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, with the parts in ASCII lower-cased; starts and ends of all parts, and each row's first one's number.

    Words with a bar are neither parted nor lower-cased.
    """
    starts, ends, first = spans(raw, rows)
    if not len(starts):
        return raw, starts, ends, first
    sort = SORT[raw]
    marks = np.zeros(raw.size + 1, bool)
    marks[starts] = True
    cuts = np.flatnonzero(APART[8 * sort[:-1] + sort[1:]] & ~marks[1:-1]) + 1
    held = raw > 127
    bars = np.flatnonzero(raw == BAR)
    if len(bars):
        held[bars] = True
        barred = np.zeros(len(starts), bool)
        barred[np.searchsorted(starts, bars, side="right") - 1] = True
        cuts = cuts[~barred[np.searchsorted(starts, cuts, side="right") - 1]]
    marks[cuts] = True
    starts = np.flatnonzero(marks)
    marks[:] = False
    marks[ends], marks[cuts] = True, True
    ends, lower = np.flatnonzero(marks), LOWER[raw]
    if held.any():
        total = np.concatenate([[0], np.cumsum(held, dtype=np.int32)])
        some = np.flatnonzero(total[ends] > total[starts])
        at = np.repeat(starts[some] - np.append(0, np.cumsum(ends[some] - starts[some])[:-1]), ends[some] - starts[some])
        at += np.arange(len(at))
        lower[at] = raw[at]
    return lower, starts, ends, np.searchsorted(starts, rows)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of that file."""
    return kept(f"tokenizer {path}", lambda: WordEncoder(path))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.table = np.full(1 << SLOTS, -1, np.int32)  # a word's number, -1 in a free slot
        self.keys, self.at, self.n = np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.array([END], np.uint32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for those that aren't kept."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = (keys >> U(64 - SLOTS)).astype(np.int32)
        found = self.table[slot]
        todo = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % (1 << SLOTS)
            found[todo] = self.table[slot[todo]]
            todo = todo[(found[todo] >= 0) & (self.keys[found[todo]] != keys[todo])]
        return found

    def _keep(self, keys: np.ndarray) -> None:
        """Numbers for words that aren't kept, each of them once."""
        slot, number = (keys >> U(64 - SLOTS)).astype(np.int32), np.arange(len(self.keys), len(self.keys) + len(keys), dtype=np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.table[slot[todo]] < 0]
            self.table[slot[free]] = number[free]
            todo = todo[self.table[slot[todo]] != number[todo]]
            slot[todo] = (slot[todo] + 1) % (1 << SLOTS)
        self.keys = np.concatenate([self.keys, keys])

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        lines = [" ".join(words[k : k + LINE]) for k in range(0, len(words), LINE)]
        got = self.tokenizer.encode_batch(lines, add_special_tokens=False)
        after = np.cumsum([len(x) + 1 for x in lines])  # characters, with the space between two lines
        places = np.fromiter((o[0] for e in got for o in e.offsets), np.int64)
        places += np.repeat(after - [len(x) + 1 for x in lines], [len(e) for e in got])
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])
        n = np.diff(np.searchsorted(places, begins))
        at = (len(self.flat) + np.cumsum(n) - n).astype(np.int32)
        self.flat = np.concatenate([self.flat, np.fromiter((i for e in got for i in e.ids), np.uint32)])
        self._keep(keys)
        self.at, self.n = np.concatenate([self.at, at]), np.concatenate([self.n, n.astype(np.int32)])

    def encode(self, raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, END after each row's; and each row's number of ids, END included."""
        raw, starts, ends, first = parts(raw, rows)
        hashes = hash_spans(raw, starts, ends)
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, which = np.unique(hashes[new], return_index=True)
            if len(self.keys) + len(unique) > KEPT_WORDS:
                self._forget()
                new = np.arange(len(hashes))
                unique, which = np.unique(hashes, return_index=True)
            data, which = raw.tobytes(), new[which]
            self._learn(unique, [data[a:b].decode("utf-8") for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)])
            found[new] = self._find(hashes[new])
        at = np.insert(self.at[found], first[1:], 0)
        n = np.insert(self.n[found], first[1:], 1)
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ids = self.flat[np.repeat(at - total[:-1], n) + np.arange(total[-1])]
        bounds = total[first + np.arange(len(first))]
        return ids, np.diff(bounds)
