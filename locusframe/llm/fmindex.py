"""A compressed FM-index over words, in numpy: suffix array, Burrows-Wheeler transform, wavelet matrix.

It is built over many short word runs at once, and searched for many windows at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector, packed, with a count of ones before every 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)
        self.ones = int(bits.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below).astype(np.int32)


def suffix_order(text: np.ndarray, most: int) -> np.ndarray:
    """Positions in order of what follows, compared over at least `most` words (0 ends a run)."""
    n, bits = len(text), int(text.max(initial=1)).bit_length()
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(min(step, n)):
        key[:n - k] |= text[k:].astype(np.int64) << bits * (step - 1 - k)
    while True:
        order = np.argsort(key, kind="stable")
        if step >= most:
            return order
        new = np.concatenate([[False], key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        step *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, most: int):
        """text: word numbers from 1, each run closed by 0; runs are at most `most` words long."""
        self.order = suffix_order(text, most)
        bwt = text[self.order - 1]
        self.levels = []
        self.depth = max(1, int(text.max(initial=1)).bit_length())
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=(1 << self.depth)))]).astype(np.int32)
        for level in range(self.depth - 1, -1, -1):
            one = (bwt >> level & 1).astype(bool)
            self.levels.append(Bits(one))
            bwt = np.concatenate([bwt[~one], bwt[one]])
        self.size = len(text)
        # where each word's block begins on the last level
        self.base = np.zeros(1 << self.depth, np.int32)
        self.base = self.rank(np.arange(1 << self.depth), np.zeros(1 << self.depth, np.int32))

    def rank(self, word: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Position on the last level that `word` among the first i has come to."""
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            one = (word >> level & 1).astype(bool)
            r = bits.rank(i)
            i = np.where(one, self.size - bits.ones + r, i - r)
        return i

    def back(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the ranges of `word` followed by what the ranges stand for."""
        start = self.starts[word] - self.base[word]
        both = self.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        k = len(word)
        return start + both[:k], start + both[k:]

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of `text` in `ends`: the length, up to `most` words, of the longest stretch that ends there and
        that the index holds more than once, and the range of that stretch."""
        length = np.zeros(len(ends), np.int32)
        first, last = np.zeros(len(ends), np.int32), np.zeros(len(ends), np.int32)
        at, word = np.arange(len(ends)), text[ends]
        low, high = self.starts[word], self.starts[word + 1]
        for k in range(1, most + 1):
            more = high - low > 1
            at, low, high = at[more], low[more], high[more]
            length[at], first[at], last[at] = k, low, high
            if k == most or not len(at):
                break
            low, high = self.back(text[ends[at] - k], low, high)
        return length, first, last


def earliest(runs: tuple[np.ndarray, np.ndarray], owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every run, the smallest owner of a run that has the same words.

    runs: (words of all runs, from 1; length of each run), each at least `window` long. Returns the
    values, run by run, and the number of windows of each run."""
    words, sizes = runs
    ends = np.cumsum(sizes + 1)
    text = np.zeros(int(ends[-1]), np.int64)
    run_of = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(words)) + run_of] = words
    index = FMIndex(text, int(sizes.max()) + 1)
    count = sizes - window + 1
    run = np.repeat(np.arange(len(sizes)), count)
    first = (ends - sizes - 1)[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    least = owner[run].copy()
    # a window that the index holds once is its own segment's
    length, low, high = index.matching_statistics(text, first + window - 1, window)
    at = np.flatnonzero(length == window)
    if len(at):
        owner_at = np.append(np.repeat(owner, sizes + 1)[index.order], np.iinfo(np.int64).max)
        begins, which = np.unique(low[at], return_inverse=True)  # equal windows have one range, others disjoint ones
        stops = np.zeros(len(begins), np.int64)
        stops[which] = high[at]
        value = np.minimum.reduceat(owner_at, np.stack([begins.astype(np.int64), stops], 1).ravel())[::2]
        least[at] = np.minimum(least[at], value[which])
    return least, count
