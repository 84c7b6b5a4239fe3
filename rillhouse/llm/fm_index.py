"""A compressed full-text index over words: a wavelet matrix of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector, 64 to a word, that counts its ones before a position."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Symbols of a text bit by bit, from the highest, each level sorted stably by its bit."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        self.n = len(text)
        self.depth = max(1, int(top).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (text >> level) & 1
            self.levels.append((Bits(bit.astype(np.uint8)), int(len(text) - bit.sum())))
            text = np.concatenate([text[bit == 0], text[bit == 1]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where, in the last level, the occurrences before ``at`` of each symbol end."""
        for k, (bits, zeros) in enumerate(self.levels):
            ones = bits.ones(at)
            set_ = (symbols >> (self.depth - 1 - k)) & 1
            at = np.where(set_ == 1, zeros + ones, at - ones)
        return at


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` or more symbols that begin there, by doubling."""
    n = len(text)
    rank, span = text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while span < depth and n:
        after = np.full(n, -1, dtype=np.int64)
        after[: max(0, n - span)] = rank[span:]
        key = rank * (int(rank.max()) + 2) + after + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        span *= 2
    return order


class FMIndex:
    """Backward search over passages of words.

    ``passages`` are arrays of word hashes; a mark that is no word stands between them. Suffixes
    are sorted by their first ``depth`` words, which is all that patterns up to that length need.
    ``owners`` has a number for each passage; of the occurrences found the smallest is reported.
    """

    def __init__(self, passages: list[np.ndarray], owners: np.ndarray, depth: int) -> None:
        self.depth = depth
        flat = np.concatenate([*passages, np.empty(0, np.uint64)])
        self.vocabulary, codes = np.unique(flat, return_inverse=True)
        sizes = np.array([len(p) for p in passages], dtype=np.int64)
        text = np.zeros(len(flat) + len(passages), dtype=np.int64)
        here = np.arange(len(flat)) + np.repeat(np.arange(len(passages)), sizes)
        text[here] = codes + 1
        order = suffix_order(text, depth)
        owner = np.repeat(owners, sizes + 1)
        self.owner = owner[order]
        self.n = len(text)
        top = len(self.vocabulary)
        self.tree = WaveletMatrix(text[order - 1], top)
        counts = np.bincount(text, minlength=top + 1)
        self.first = np.cumsum(counts) - counts
        symbols = np.arange(top + 1)
        self.zero = self.tree.place(symbols, np.zeros(top + 1, dtype=np.int64))

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; 0, which stands in no passage, for those of no passage."""
        if not len(self.vocabulary):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    def smallest_owner(self, words: np.ndarray, begins: np.ndarray, own: np.ndarray) -> np.ndarray:
        """For the ``depth`` words from each of ``begins``, the smallest owner below ``own``.

        All patterns are matched backwards together, a word a step; one leaves when nothing matches
        any more, or when only one passage does, which is then looked up. Where no smaller owner
        has the pattern, ``own`` itself is returned.
        """
        symbols = self.codes(words)
        found = own.copy()
        alive = np.arange(len(begins))
        low = np.zeros(len(begins), dtype=np.int64)
        high = np.full(len(begins), self.n, dtype=np.int64)
        for step in range(self.depth - 1, -1, -1):
            c = symbols[begins[alive] + step]
            both = self.tree.place(np.concatenate([c, c]), np.concatenate([low, high]))
            shift = self.first[c] - self.zero[c]
            low, high = both[: len(c)] + shift, both[len(c) :] + shift
            stay = (high > low) & (c > 0)
            # a single occurrence whose owner is not smaller can't become one that is
            lone = high - low == 1
            stay &= ~lone | (self.owner[np.minimum(low, self.n - 1)] < own[alive])
            if not stay.all():
                alive, low, high = alive[stay], low[stay], high[stay]
            if not len(alive):
                return found
        spans, which = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
        owners = np.append(self.owner, np.iinfo(np.int64).max)
        smallest = np.minimum.reduceat(owners, spans.T.ravel())[::2]
        found[alive] = np.minimum(found[alive], smallest[which.ravel()])
        return found
