"""Texts as chunks, each coded once and remembered.

A batch of texts is one byte array with a space ahead of each text.  A chunk
is a run of spaces with the word behind it, a word at the start of a line, or
a line feed.  Cutting, hashing, looking up and gluing the codes together are
array operations; only a chunk not seen before becomes a string, which the
tokenizer's ``learn`` turns into ids.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .bpe import mixed

#: Chunks that a Python worker remembers (about 40 bytes each).
REMEMBERED = 3_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


class HashIndex:
    """Numbers by 64-bit hashes, in a table of places that is half empty; a
    taken place sends on to the next one.  All steps are array operations."""

    def __init__(self, places: int = 1 << 12):
        self.keys, self.numbers, self.count = np.zeros(places, dtype=np.uint64), np.zeros(places, dtype=np.int32), 0

    @staticmethod
    def _key(h: np.ndarray) -> np.ndarray:
        return np.where(h == 0, np.uint64(1), h)  # 0 marks an empty place

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those not there."""
        h, mask = self._key(h), np.uint64(len(self.keys) - 1)
        out, rest, at = np.full(len(h), -1, dtype=np.int64), np.arange(len(h)), h & mask
        while len(rest):
            here = self.keys[at]
            same = here == h[rest]
            out[rest[same]] = self.numbers[at[same]]
            on = ~same & (here != 0)
            rest, at = rest[on], (at[on] + np.uint64(1)) & mask
        return out

    def add(self, h: np.ndarray, numbers: np.ndarray) -> None:
        """Add hashes that differ from each other and are not there."""
        if 2 * (self.count + len(h)) > len(self.keys):
            bigger = HashIndex(1 << (4 * (self.count + len(h))).bit_length())
            used = np.flatnonzero(self.keys)
            bigger._put(self.keys[used], self.numbers[used])
            self.keys, self.numbers = bigger.keys, bigger.numbers
        self._put(self._key(h), numbers)
        self.count += len(h)

    def _put(self, h: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at = h & mask
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[free]               # of several at one place the last one stays
            won = free & (self.keys[at] == h)
            self.numbers[at[won]] = numbers[won]
            h, numbers, at = h[~won], numbers[~won], (at[~won] + np.uint64(1)) & mask


class ChunkCoder:
    """``learn`` takes chunks (strings) and keys (zeros) and gives the ids of
    all, one chunk's behind the other's, and how many each has."""

    def __init__(self, learn: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self.learn, self.remembered = learn, remembered
        self.power = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex()
        self.pool, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.start, self.size, self.count = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64), 0

    def _hashes(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        longest = int(sizes.max())
        if longest > len(self.power):
            self.power = np.r_[np.uint64(1), np.cumprod(np.full(2 * longest, BASE | np.uint64(1)))]
        place = np.arange(len(raw)) - np.repeat(starts, sizes)
        return np.add.reduceat(BYTE[raw] * self.power[place], starts) + sizes.astype(np.uint64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each remembered chunk, -1 for the others."""
        return self.index.find(h)

    def _add(self, h: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remember new chunks, all different; their numbers."""
        n = len(sizes)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + n > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        numbers = np.arange(self.count, self.count + n)
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[numbers], self.size[numbers] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.count = self.used + len(ids), self.count + n
        self.index.add(h, numbers)
        return numbers

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of remembered chunks."""
        start, n = self.start[numbers], self.size[numbers]
        ends = np.cumsum(n)
        return self.pool[np.arange(ends[-1] if len(n) else 0) + np.repeat(start - (ends - n), n)], n

    def encode(self, texts: list[bytes], vary: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more for the end).
        ``vary(chunk numbers, text numbers, places in the text, chunk_at)``
        gives the occurrences that have ids of their own, those ids, and how
        many each has."""
        if self.count > self.remembered:
            self._forget()
        buffer = b"".join([b" " + t if t else b"" for t in texts])
        length = np.fromiter((len(t) + 1 if t else 0 for t in texts), dtype=np.int64, count=len(texts))
        if not buffer:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        raw = np.frombuffer(buffer, dtype=np.uint8)
        space, feed = raw == 32, raw == 10
        new = feed.copy()
        new[1:] |= (space[1:] & ~space[:-1]) | feed[:-1]
        first = np.cumsum(length) - length
        new[first[length > 0]] = True
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(raw)])
        h = self._hashes(raw, starts, sizes)
        before = np.searchsorted(starts, np.r_[first, len(raw)])  # chunks ahead of each text

        def chunk_at(places: np.ndarray) -> list[str]:
            return [buffer[s:e].decode("utf-8", "replace") for s, e in zip(starts[places].tolist(), (starts[places] + sizes[places]).tolist())]

        h, at, back = np.unique(mixed(h), return_index=True, return_inverse=True)
        number = self._find(h)
        if (lack := np.flatnonzero(number < 0)).size:
            a = at[lack]
            number[lack] = self._add(h[lack], *self.learn(chunk_at(a), np.zeros(len(a), dtype=np.uint64)))
        number = number[back]
        start, n = self.start[number], self.size[number]
        if vary:
            at, own, sizes = vary(number, np.repeat(np.arange(len(texts)), np.diff(before)),
                             np.arange(len(starts)) - np.repeat(before[:-1], np.diff(before)), chunk_at)
            while self.used + len(own) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            # behind what is remembered, until the next batch
            self.pool[self.used : self.used + len(own)] = own
            n[at] = sizes
            start[at] = self.used + np.cumsum(n[at]) - n[at]
        ends = np.cumsum(n)
        ids = self.pool[np.arange(ends[-1]) + np.repeat(start - (ends - n), n)]
        return ids, np.r_[0, ends][before]
