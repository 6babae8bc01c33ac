"""Suffix arrays over the words of a shard of texts, and binary search in them."""

from __future__ import annotations

import numpy as np


class SuffixArray:
    """The places of a shard's words, sorted by the words that follow.

    ``ranks`` holds the words of all texts as small positive integers, with a 0 after each text,
    so no match runs across texts. Places are sorted by their next ``depth`` words or more; where
    so many agree, the order is left open, because a search never looks deeper.
    """

    def __init__(self, ranks: np.ndarray, distinct: int, depth: int):
        self.depth = depth
        bits = max(1, int(distinct).bit_length())
        self.per_key = max(1, 63 // bits)
        self.bits = np.int64(bits)
        self.size = len(ranks)
        self.ranks = np.concatenate([ranks, np.zeros(depth + self.per_key, dtype=np.int64)])
        keys = self._packed(self.ranks, self.size)
        self.order = np.argsort(keys)
        self.first_keys = keys[self.order]
        self._refine(keys)

    def _packed(self, ranks: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, dtype=np.int64)
        for j in range(self.per_key):
            out = (out << self.bits) | ranks[j : j + n]
        return out

    def _refine(self, keys: np.ndarray) -> None:
        """Sorts the places that still agree by the next words, as often as ``depth`` asks."""
        same = self.first_keys[1:] == self.first_keys[:-1]
        for done in range(self.per_key, self.depth, self.per_key):
            tied = np.zeros(self.size, dtype=bool)
            tied[1:] = same
            tied[:-1] |= same
            at = np.flatnonzero(tied)
            if not len(at):
                return
            group = np.cumsum(np.concatenate([[True], ~same]))[at]
            places = self.order[at]
            # Past the end there are only zeros, and a padded place is never compared further.
            following = keys[np.minimum(places + done, self.size - 1)]
            following[places + done >= self.size] = 0
            by = np.lexsort((following, group))
            self.order[at] = places[by]
            group, following = group[by], following[by]
            equal = (group[1:] == group[:-1]) & (following[1:] == following[:-1])
            same = np.zeros(self.size - 1, dtype=bool)
            near = at[1:] == at[:-1] + 1
            same[at[:-1][near]] = equal[near]

    def ranges(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern (a row of ``words``, -1 for a word the shard lacks) the part of the
        order whose places begin with it."""
        low = np.zeros(len(words), dtype=np.int64)
        high = np.zeros(len(words), dtype=np.int64)
        known = np.flatnonzero(
            ~((words < 0) & (np.arange(words.shape[1]) < lengths[:, None])).any(axis=1)
        )
        # The first words decide most patterns.
        head = np.zeros(len(known), dtype=np.int64)
        tail = np.zeros(len(known), dtype=np.int64)
        for j in range(self.per_key):
            within = (j < lengths[known]) & (j < words.shape[1])
            word = words[known, min(j, words.shape[1] - 1)]
            head = (head << self.bits) | np.where(within, word, 0)
            tail = (tail << self.bits) | np.where(within, word, (1 << int(self.bits)) - 1)
        left = np.searchsorted(self.first_keys, head, "left")
        right = np.searchsorted(self.first_keys, tail, "right")
        found = left < right
        known, left, right = known[found], left[found], right[found]
        low[known] = self._bound(words[known], lengths[known], left, right, after=False)
        high[known] = self._bound(words[known], lengths[known], left, right, after=True)
        return low, high

    def _bound(self, words, lengths, left, right, *, after: bool) -> np.ndarray:
        """Binary search of all patterns at once: the first place in order that is not before
        (or, with ``after``, that is behind) the pattern."""
        low, high = left.copy(), right.copy()
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) // 2
            place = self.order[middle]
            sign = np.zeros(len(busy), dtype=np.int64)
            for j in range(words.shape[1]):
                here = np.sign(self.ranks[place + j] - words[busy, j])
                sign = np.where((sign == 0) & (j < lengths[busy]), here, sign)
            before = sign <= 0 if after else sign < 0
            low[busy] = np.where(before, middle + 1, low[busy])
            high[busy] = np.where(before, high[busy], middle)
        return low


def expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges, the index of the range and the member, for each member of each."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return which, low[which] + within
