"""What each chunk of a text between spaces is encoded to, looked up for whole batches of texts at once.

Byte-level tokenizers encode each match of a pattern on its own, and no match reaches over a single space
or line break between other characters, other than by taking the space in front of it. So a text without
neighbouring white space is cut in front of its spaces and line breaks; all chunks of a batch are hashed
by running sums, and the hashes are looked up in an open table of arrays. Texts with neighbouring white
space, or with bytes that could begin white space outside ASCII, are encoded as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from claimspan.llm.common import _IS_SPACE, Rolling, by_size

#: Distinct chunks that a worker remembers; beyond that it starts anew between batches.
CACHE = 700_000
_SLOTS = 1 << 21
BATCH = 4 << 20

_CUT = np.zeros(256, bool)
_CUT[[32, 10]] = True
#: First bytes of the characters outside ASCII that are white space.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def compiled(pattern: str):
    """``pattern`` with white space as Unicode defines it, as the tokenizer libraries read ``\\s``."""
    return regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


class ChunkTable:
    """``encode`` gets a list of byte strings and returns all their ids and the number of ids of each."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode, self.rolling = encode, Rolling()
        self._reset()

    def _reset(self) -> None:
        self.key, self.number = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.int32)
        self.ids, self.begin, self.n = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each hash, or the empty slot where it would stand, and whether it is there."""
        slot = (h & np.uint64(_SLOTS - 1)).astype(np.int64)
        open_ = np.flatnonzero((self.key[slot] != h) & (self.key[slot] != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (_SLOTS - 1)
            found = self.key[slot[open_]]
            open_ = open_[(found != h[open_]) & (found != 0)]
        return slot, self.key[slot] == h

    def _learn(self, h: np.ndarray, chunks: list[bytes]) -> None:
        """Add distinct new hashes and what their chunks are encoded to."""
        flat, lengths = self.encode(chunks)
        used, n = int(self.begin[self.n]), self.n + len(lengths)
        if used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(used + len(flat), np.uint32)])
        if n + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(n + 1, np.int64)])
        self.ids[used : used + len(flat)] = flat
        self.begin[self.n + 1 : n + 1] = used + np.cumsum(lengths)
        left, numbers = h, np.arange(self.n, n, dtype=np.int32)
        while len(left):
            slot, _ = self._find(left)
            self.key[slot] = left  # where two meet in one slot, the later one stands and the others go on
            self.number[slot] = numbers
            lost = self.key[slot] != left
            left, numbers = left[lost], numbers[lost]
        self.n = n

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text; about BATCH bytes are worked on at a time."""
        return [ids for a, b in by_size(texts, BATCH) for ids in self._batch(texts[a:b])]

    def _batch(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.n > CACHE:
            self._reset()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        space = _IS_SPACE[data]
        odd = _MAYBE_SPACE[data]
        odd[1:] |= space[1:] & space[:-1]
        plain = np.zeros(len(texts), bool)
        full = lengths > 0
        plain[full] = ~np.logical_or.reduceat(odd, starts[full]) if full.any() else True
        for k in np.flatnonzero(full & ~plain):
            out[k] = self.encode([texts[k]])[0]
        cut = _CUT[data]
        cut[starts[full]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(data))
        text = np.searchsorted(ends, begin, "right")
        keep = plain[text]
        begin, end, text = begin[keep], end[keep], text[keep]
        if not len(begin):
            return out
        h = self.rolling.hash(self.rolling.sums(data), begin, end)
        h[h == 0] = 1
        slot, known = self._find(h)
        if not known.all():
            new = np.flatnonzero(~known)
            distinct, first = np.unique(h[new], return_index=True)
            if self.n + len(distinct) > _SLOTS // 2:
                self._reset()
                distinct, first = np.unique(h, return_index=True)
                new = np.arange(len(h))
            raw = data.tobytes()
            at = new[first]
            self._learn(distinct, [raw[b:e] for b, e in zip(begin[at].tolist(), end[at].tolist())])
            slot, _ = self._find(h)
        number = self.number[slot]
        b = self.begin[number]
        n = self.begin[number + 1] - b
        done = np.cumsum(n)
        ids = self.ids[np.arange(done[-1]) + np.repeat(b - (done - n), n)]
        last = np.flatnonzero(np.append(text[1:] != text[:-1], True))
        for k, part in zip(text[last].tolist(), np.split(ids, done[last][:-1])):
            out[k] = part
        return out
