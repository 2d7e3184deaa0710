"""Word shingles of whole texts as sorted arrays of 64-bit hashes, and the
signatures by which similar sets are found."""
from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from .bpe import MASK, mixed

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Hash of each byte; white space (x20, x09-x0D) has none, A-Z that of a-z.
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
BYTE = np.where(BLANK, np.uint64(0), mixed((_LOWER + 1).astype(np.uint64) * BASE))
_POWERS = [np.cumprod(np.r_[np.uint64(1), np.full(1023, BASE | np.uint64(1))])]


def _power(n: int) -> np.ndarray:
    while len(_POWERS[0]) < n:
        _POWERS[0] = np.r_[_POWERS[0], _POWERS[0] * _POWERS[0][-1] * (BASE | np.uint64(1))]
    return _POWERS[0]


def word_hashes(text: bytes) -> np.ndarray:
    """One hash for each word of a text, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    blank = BLANK[raw]
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]]) if len(raw) else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = np.diff(np.r_[starts, len(raw)])
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, sizes)
    return mixed(np.add.reduceat(BYTE[raw[starts[0]:]] * _power(int(sizes.max()))[place], starts - starts[0]))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; with fewer words
    the whole sequence is one; without words there is none."""
    words = word_hashes(text)
    n = min(width, len(words))
    if not n:
        return words
    count = len(words) - n + 1
    h = np.full(count, n, dtype=np.uint64)
    for k in range(n):
        h = mixed(h * BASE + words[k : k + count])
    return np.unique(h)


class Signer:
    """Tile keys for sets that must share ``percent`` of their union.

    Two linked sets of sizes s <= r differ in at most
    ``(100 - percent) / (100 + percent) * (s + r)`` shingles.  A tile is a
    band of sizes; it deals the shingles into parts by their hash.  Of more
    parts than differences, one part at least is equal in both sets, also if
    only parts of ``rich`` shingles are counted.  So a set enters a tile with
    its first rich parts, one more than it can have differences; a set that
    has not so many enters it with all parts, poor and empty ones too.  Sets
    near the lower end of a band also enter the tile below.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.ratio = 100 / percent
        self.rich = 4 if percent >= 90 else 2
        per_part = 6.0 if percent >= 90 else 3.2
        self.differ = (100 - percent) / (100 + percent)
        self.per_part = per_part

    @lru_cache(maxsize=4096)
    def band(self, b: int) -> tuple[int, int, int]:
        """(first size, first size of the next band, parts) of band ``b``."""
        lo, hi = (math.ceil(self.ratio ** (2 * x) - 1e-9) for x in (b, b + 1))
        return lo, hi, max(self.differences(hi - 1, self.largest(hi - 1)) + 1, round(hi / self.per_part))

    def band_of(self, n: int) -> int:
        b = int(math.log(n) / math.log(self.ratio) / 2)
        while self.band(b)[0] > n:
            b -= 1
        while self.band(b)[1] <= n:
            b += 1
        return b

    def largest(self, n: int) -> int:
        return 100 * n // self.percent

    def differences(self, s: int, r: int) -> int:
        return (100 - self.percent) * (s + r) // (100 + self.percent)

    def keys(self, sh: np.ndarray) -> np.ndarray:
        """Tile keys of a set of shingles."""
        n = len(sh)
        if not n or not self.differences(n, self.largest(n)):
            return np.zeros(0, dtype=np.int64)
        b = self.band_of(n)
        out = [self._tile(sh, b, self.differences(n, self.largest(n)) + 1)]
        below = self.band(b)[0] - 1
        if below and 100 * below >= self.percent * n:
            out.append(self._tile(sh, b - 1, self.differences(below, n) + 1))
        return np.concatenate(out).view(np.int64)

    def _tile(self, sh: np.ndarray, b: int, need: int) -> np.ndarray:
        parts = self.band(b)[2]
        at = (sh % np.uint64(parts)).astype(np.int64)
        total = np.zeros(parts, dtype=np.uint64)
        np.add.at(total, at, mixed(sh + BASE))
        rich = np.flatnonzero(np.bincount(at, minlength=parts) >= self.rich)
        chosen = rich[:need] if len(rich) >= need else np.arange(parts)
        tile = np.uint64(mixed(b + 1))
        return mixed(mixed(total[chosen] + tile) + chosen.astype(np.uint64))


def bitmap(sh: np.ndarray) -> bytes:
    """Parity of the shingles that hash to each bit; the number of bits is a
    power of two, about two for each shingle, 64 at least."""
    bits = max(64, 1 << (2 * len(sh)).bit_length())
    odd = np.bincount((mixed(sh) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(x: int, x_size: int, y: int, y_size: int) -> int:
    """Bits in which two bitmaps differ; the longer one is folded first."""
    while x_size > y_size:
        x_size //= 2
        x = (x >> x_size) ^ (x & (1 << x_size) - 1)
    while y_size > x_size:
        y_size //= 2
        y = (y >> y_size) ^ (y & (1 << y_size) - 1)
    return (x ^ y).bit_count()


def overlap_bound(a: bytes, n: int, b: bytes, r: int) -> int:
    """Most shingles two sets of ``n`` and ``r`` can share: each differing
    parity bit is a shingle that one of them lacks."""
    return (n + r - differing_bits(int.from_bytes(a, "little"), 8 * len(a), int.from_bytes(b, "little"), 8 * len(b))) // 2
