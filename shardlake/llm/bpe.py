"""Byte-pair merges of many words at once.

``MergeTable`` holds a tokenizer's merges as sorted arrays.  Words become rows
of symbols; each round finds, in every row that still has one, the best-ranked
adjacent pair (the leftmost of equals) and merges it.  That is the order in
which the tokenizer's own agenda takes them, so the ids are the same.
"""
from __future__ import annotations

import heapq

import numpy as np

#: Longer words go through a heap one by one, shorter ones through arrays.
LONG_WORD = 64
ROWS = 16_000
NO_MERGE = np.int32(2 ** 31 - 1)
UNKNOWN, PADDING, GONE = -2, -1, -3
MASK = 2 ** 64 - 1
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x):
    """A 64-bit finaliser; takes Python ints or uint64 arrays."""
    if isinstance(x, int):
        x = ((x ^ (x >> 30)) * MIX_1) & MASK
        x = ((x ^ (x >> 27)) * MIX_2) & MASK
        return x ^ (x >> 31)
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(MIX_1)
    z = y >> np.uint64(27)
    y ^= z
    y *= np.uint64(MIX_2)
    np.right_shift(y, np.uint64(31), out=z)
    y ^= z
    return y


PLACE = 0x9E3779B97F4A7C15


def candidate(place, left, right):
    """A number for the merge of two symbols at a place (first character) of a
    word, 64 bits; ints or arrays."""
    if isinstance(place, int):
        return mixed(((((left & 0xFFFFFFFF) << 32) | (right & 0xFFFFFFFF)) + place * PLACE) & MASK)
    pair = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    return mixed(pair + place.astype(np.uint64) * np.uint64(PLACE))


def coin(key, merge):
    """The keyed hash of one candidate merge, 64 bits; ints or arrays."""
    return mixed((key + merge) & MASK) if isinstance(key, int) else mixed(key + merge)


def found(among: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def in_order(blocks: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, counts) of ``n`` rows, from blocks (rows, numbers, counts)."""
    sizes = np.zeros(n, dtype=np.int64)
    for rows, _, own in blocks:
        sizes[rows] = own
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if n else 0, dtype=np.int32)
    for rows, numbers, own in blocks:
        out[np.arange(len(numbers)) + np.repeat(ends[rows] - np.cumsum(own), own)] = numbers
    return out, sizes


def traced(trace: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(merges, counts) of ``n`` words, each word's in the order they were made."""
    word, turn = (np.concatenate([np.zeros(0, dtype=np.int64), *(x[k] for x in trace)]) for k in (0, 1))
    made = np.concatenate([np.zeros(0, dtype=np.uint64), *(x[2] for x in trace)])
    sizes = np.bincount(word, minlength=n)
    out = np.zeros_like(made)
    out[(np.cumsum(sizes) - sizes)[word] + turn] = made
    return out, sizes


class MergeTable:
    """``pairs``: (left symbol, right symbol) to (rank, merged symbol); the
    least rank merges first, and a rank stands for one merged symbol."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.pairs = pairs
        keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.int64)
        ranks = np.array([r for r, _ in pairs.values()], dtype=np.int32)
        self.merged = np.zeros(int(ranks.max()) + 1, dtype=np.int32)
        self.merged[ranks] = [m for _, m in pairs.values()]
        # pairs by a hash of theirs: a few to a bucket, most buckets empty
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        bucket = self._bucket(keys)
        by = np.argsort(bucket, kind="stable")
        self.keys, self.ranks = keys[by], ranks[by]
        counts = np.bincount(bucket, minlength=1 << (64 - int(self.shift)))
        self.buckets = np.r_[0, np.cumsum(counts)].astype(np.int32)

    def _bucket(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(PLACE) >> self.shift).astype(np.int64)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_MERGE for those that do not merge."""
        out = np.full(len(pairs), NO_MERGE, dtype=np.int32)
        bucket = self._bucket(pairs)
        at, end = self.buckets[bucket], self.buckets[bucket + 1]
        rest = np.flatnonzero(at < end)
        while len(rest):
            same = self.keys[at[rest]] == pairs[rest]
            out[rest[same]] = self.ranks[at[rest[same]]]
            rest = rest[~same]
            at[rest] += 1
            rest = rest[at[rest] < end[rest]]
        return out

    def one(self, syms: list[int], key: int = 0, limit: int = 0, trace: list | None = None,
            skips: set[int] | None = None) -> list[int]:
        """The symbols of one word after all its merges, through a heap.  A
        merge is skipped if its keyed hash is below ``limit`` (of 2**64), or
        one of ``skips``.  ``trace`` takes the number of every merge that was
        made."""
        syms = list(syms)
        after, before, alive = list(range(1, len(syms))) + [-1], list(range(-1, len(syms) - 1)), [True] * len(syms)
        agenda: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (got := self.pairs.get((syms[i], syms[j]))):
                toss = coin(key, candidate(i, syms[i], syms[j])) if limit or skips else limit
                if toss >= limit and not (skips and toss in skips):
                    heapq.heappush(agenda, (got[0], i, syms[i], syms[j], got[1]))

        for i in range(len(syms) - 1):
            offer(i)
        while agenda:
            _, i, left, right, new = heapq.heappop(agenda)
            j = after[i]
            if not alive[i] or j < 0 or syms[i] != left or syms[j] != right:
                continue
            if trace is not None:
                trace.append(candidate(i, left, right))
            syms[i], alive[j], after[i] = new, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s, a in zip(syms, alive) if a]

    def many(self, flat: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None, limit: int = 0,
             trace: list | None = None, skips: np.ndarray | None = None) -> list[bytes]:
        """``merge`` with the final symbols of each word as little-endian int32 bytes."""
        ids, sizes = self.merge(flat, lengths, keys, limit, trace, skips)
        raw, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:z] for a, z in zip([0, *ends], ends)]

    def merge(self, flat: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None, limit: int = 0,
              trace: list | None = None, skips: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(final symbols of all words, how many of each); ``flat`` holds the
        first symbols of all words, one after the other.  ``skips`` are keyed
        hashes (sorted) of merges to skip.  ``trace`` takes arrays (words,
        which merge of the word, candidates) of all merges that were made."""
        starts = np.cumsum(lengths) - lengths
        keys = np.zeros(len(lengths), dtype=np.uint64) if keys is None else keys
        skip_set = None if skips is None or not (lengths > LONG_WORD).any() else set(skips.tolist())
        blocks = []
        for i in np.flatnonzero(lengths > LONG_WORD):
            made = None if trace is None else []
            word = self.one(flat[starts[i] : starts[i] + lengths[i]].tolist(), int(keys[i]), limit, made, skip_set)
            if made:
                trace.append((np.full(len(made), i), np.arange(len(made)), np.array(made, dtype=np.uint64)))
            blocks.append((np.array([i]), np.array(word, dtype=np.int32), np.array([len(word)])))
        for lo, hi in ((0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8), (8, 10), (10, 12), (12, 16), (16, 24), (24, 40), (40, LONG_WORD)):
            rows = np.flatnonzero((lengths > lo) & (lengths <= hi))
            for a in range(0, len(rows), ROWS):
                part = rows[a : a + ROWS]
                blocks.append((part, *self._rounds(flat, starts[part], lengths[part], keys[part], (limit, skips), part, trace)))
        return in_order(blocks, len(lengths))

    def _offers(self, left, right, place, keys, limit):
        """Rank of each pair, NO_MERGE where there is no merge or it is skipped
        (a symbol below 0 makes a number below 0, which no pair has)."""
        ranks = self._ranks((left.astype(np.int64) << 32) | right)
        limit, skips = limit
        if limit or skips is not None:
            hit = np.flatnonzero(ranks != NO_MERGE)
            toss = coin(keys[hit], candidate(place[hit], left[hit], right[hit]))
            ranks[hit[toss < np.uint64(limit) if skips is None else found(skips, toss)]] = NO_MERGE
        return ranks

    def _rounds(self, flat, starts, lengths, keys, limit, words, trace):
        """(final symbols, one row behind the other; how many of each row).
        Symbols keep their places: a merge takes the right one away and links
        the left one to what follows.  The tables' cells are taken by their
        number, row after row."""
        n, width = len(lengths), int(lengths.max())
        w1 = width + 1
        inside = np.arange(w1) < lengths[:, None]
        syms = np.full((n, w1), PADDING, dtype=np.int32)
        syms[inside] = flat[(starts[:, None] + np.arange(w1))[inside]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int8), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int8), (n, 1))
        ranks = np.full((n, w1), NO_MERGE, dtype=np.int32)
        at = np.flatnonzero(inside[:, 1:].ravel())
        row, place = np.divmod(at, width)
        at += row
        cells = syms.ravel()
        ranks.ravel()[at] = self._offers(cells[at], cells[at + 1], place, keys[row], limit)
        rows, final, turn = np.arange(n), syms, 0
        while len(rows):
            best = ranks.argmin(axis=1)
            cells, to, back, rank = syms.ravel(), after.ravel(), before.ravel(), ranks.ravel()
            left = np.arange(len(rows)) * w1 + best
            top = rank[left]
            go = np.flatnonzero(top != NO_MERGE)
            if 2 * len(go) < len(rows):     # most are done: put them aside
                if syms is not final:
                    final[rows] = syms
                rows, syms, after, before, ranks, best, top = (x[go] for x in (rows, syms, after, before, ranks, best, top))
                cells, to, back, rank = syms.ravel(), after.ravel(), before.ravel(), ranks.ravel()
                go = np.arange(len(rows))
                left = go * w1 + best
            elif len(go) < len(rows):
                best, left, top = best[go], left[go], top[go]
            base = left - best
            right = base + to[left]
            then = to[right]
            if trace is not None:
                trace.append((words[rows[go]], np.full(len(go), turn), candidate(best, cells[left], cells[right])))
                turn += 1
            new = self.merged[top]
            cells[left], cells[right] = new, GONE
            rank[right] = NO_MERGE
            to[left] = then
            last = np.flatnonzero(then <= width)
            next_ = base + np.minimum(then, width)
            back[next_[last]] = best[last]
            ahead = back[left]
            k = np.flatnonzero(ahead >= 0)
            front = base[k] + ahead[k]
            own = keys[rows[go]]
            rank[both(left, front)] = self._offers(both(new, cells[front]), both(cells[next_], new[k]),
                                                   both(best, ahead[k]), both(own, own[k]), limit)
        if syms is not final and len(rows):
            final[rows] = syms
        kept = (final != PADDING) & (final != GONE)
        return final[kept], kept.sum(axis=1)


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate((a, b))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the words as numbers, and the words' lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.fromiter(map(len, words), dtype=np.int64, count=len(words))
