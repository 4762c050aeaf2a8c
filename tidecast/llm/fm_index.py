"""An FM-index over integer symbols with a wavelet matrix and sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. Zeros are separators, each smaller than the next one.

    A rank is the first place of a suffix's group; after the first sort, by three symbols or two,
    only suffixes that still share a group are sorted again. Places and ranks are of 32 bits.
    """
    n = len(symbols)
    zeros = symbols == 0
    rank = symbols.astype(np.int32)
    rank += np.int32(np.count_nonzero(zeros) + 1)
    rank[zeros] = np.arange(1, np.count_nonzero(zeros) + 1)
    bits = int(rank.max(initial=1)).bit_length()
    step = 3 if bits <= 20 else 2
    key = rank.astype(np.int64)
    for k in range(1, step):
        key <<= bits
        key[: max(0, n - k)] |= rank[k:]
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    groups = _starts(key, np.arange(n, dtype=np.int32))
    del key
    rank[order] = groups
    active = _shared(groups)
    del groups
    while len(active):
        suffixes = order[active]
        key = rank[suffixes].astype(np.int64) * (n + 1)
        inside = np.flatnonzero(suffixes < n - step)
        key[inside] += rank[suffixes[inside] + step] + 1
        sort = np.argsort(key)
        order[active] = suffixes[sort]
        groups = _starts(key[sort], active)
        rank[order[active]] = groups
        active = active[_shared(groups)]
        step *= 2
    return order


def _starts(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each of the sorted keys the place of the first equal one."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(first, dtype=np.int32)
    group -= 1
    return places[first][group]


def _shared(groups: np.ndarray) -> np.ndarray:
    """Where a group has more than one member."""
    same = groups[1:] == groups[:-1]
    return np.flatnonzero(np.append(same, False) | np.append(False, same)).astype(np.int32) if len(groups) else np.zeros(0, np.int32)


class BitRank:
    """Ones before a place: bits in words of 64, and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        packed = np.packbits(bits, bitorder="little")
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words)
        self.counts = np.cumsum(ones, dtype=np.int32) - ones

    def __call__(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit plane per level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[BitRank] = []
        self.zeros: list[int] = []
        at = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = ((at >> level) & 1).astype(bool)
            self.ones.append(BitRank(bit))
            self.zeros.append(int(len(at) - np.count_nonzero(bit)))
            at = np.concatenate([at[~bit], at[bit]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its ``end``."""
        start, end = np.zeros_like(end), end.copy()
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = (symbol >> level) & 1
            ones, zeros = self.ones[k], self.zeros[k]
            before = ones(start)
            start = np.where(bit == 1, zeros + before, start - before)
            before = ones(end)
            end = np.where(bit == 1, zeros + before, end - before)
        return end - start


class FMIndex:
    """Searches all patterns of one length at once; patterns hold no zero."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 8):
        order = suffix_order(symbols)
        self.size = len(symbols)
        self.last = symbols[order - 1]  # the transform; position 0 looks back to the closing separator
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        self.matrix = WaveletMatrix(self.last, sigma)
        kept = (order % sample == 0) | (self.last == 0)
        self.kept = kept
        self.kept_before = BitRank(kept)
        self.positions = order[kept]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the rows of ``patterns``, by backward search; those without any drop out on the way."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        todo = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[todo, j]
            low[todo] = self.before[c] + self.matrix.rank(c, low[todo])
            high[todo] = self.before[c] + self.matrix.rank(c, high[todo])
            todo = todo[low[todo] < high[todo]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: steps back to a sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.kept[rows])
        while len(todo):
            c = self.last[rows[todo]]
            rows[todo] = self.before[c] + self.matrix.rank(c, rows[todo])
            steps[todo] += 1
            todo = todo[~self.kept[rows[todo]]]
        return self.positions[self.kept_before(rows)] + steps

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, position) of every occurrence."""
        low, high = self.ranges(patterns)
        many = np.maximum(0, high - low)
        of = np.repeat(np.arange(len(patterns)), many)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        return of, self.locate(low[of] + inside) if len(of) else of
