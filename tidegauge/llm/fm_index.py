"""A compressed full-text index over sequences of words, for many searches at once.

The index holds the Burrows-Wheeler transform of the words in a wavelet tree (levelwise, one packed bit
vector and its counts per bit of the word numbers). Searches run backwards: the interval of suffixes that
begin with ``wP`` comes from that of ``P`` by two ranks in the tree. All arguments are arrays, so one
step serves all streamed sequences together.

Suffixes are sorted by their first ``depth`` words only, which is all that matches of that length need: an
interval of fewer than ``depth`` words is a run of whole classes of that order, and ranks at its bounds are exact.
"""

from __future__ import annotations

import numpy as np

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class WaveletTree:
    """Ranks of symbols in a sequence, one level per bit from the highest on, zeros before ones."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.words: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols.astype(np.uint32)
        for shift in range(self.bits - 1, -1, -1):
            bit = (current >> np.uint32(shift)) & np.uint32(1)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, dtype=np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32))
            one = bit.astype(bool)
            self.zeros.append(int(len(bit) - ones.sum()))
            current = np.concatenate([current[~one], current[one]])
        # where each symbol's occurrences begin below the last level; -1: there are none
        self.first = np.full(size, -1, dtype=np.int64)
        begins = np.flatnonzero(np.r_[True, current[1:] != current[:-1]]) if len(current) else []
        self.first[current[begins]] = begins

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        place = at.copy()
        for level, shift in enumerate(range(self.bits - 1, -1, -1)):
            block = place >> 6
            below = ~(_ALL << (place & 63).astype(np.uint64))
            ones = self.counts[level][block] + np.bitwise_count(self.words[level][block] & below)
            one = (symbol >> shift) & 1 == 1
            place = np.where(one, self.zeros[level] + ones, place - ones)
        first = self.first[symbol]
        return np.where(first < 0, 0, place - first)


def _pairs(left: np.ndarray, right: np.ndarray, apart: int) -> np.ndarray:
    """Numbers, in order, of the pairs (left[i], right[i + apart]); beyond the end the pair is the least."""
    both = left.astype(np.int64) * (len(left) + 2)
    both[: max(0, len(right) - apart)] += right[apart:].astype(np.int64) + 1
    return _ranks(both)


def _ranks(values: np.ndarray) -> np.ndarray:
    """The numbers of the values in order, from 0 on, in half the space."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    ranks = np.empty(len(values), dtype=np.int32)
    ranks[order] = np.cumsum(np.r_[False, values[1:] != values[:-1]][: len(values)], dtype=np.int32)
    return ranks


class FMIndex:
    """Index of sequences of word numbers from 1 to ``size`` - 1, each followed by the number 0."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        """``depth`` is the length of the matches, two at least."""
        text = text.astype(np.int64)
        self.size, self.depth = size, depth
        known = {1: _ranks(text)}
        step = 1
        while 2 * step < depth:
            known[2 * step] = _pairs(known[step], known[step], step)
            step *= 2
        shorter, whole = (_pairs(known[step], known[step], d - step) if d > step else known[step] for d in (depth - 1, depth))
        order = np.argsort(whole, kind="stable")
        self.order = order
        self.tree = WaveletTree(text[order - 1], size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))[:-1]])
        low = np.r_[True, shorter[order][1:] != shorter[order][:-1]] if len(text) else np.zeros(0, bool)
        starts = np.flatnonzero(low)
        group = np.cumsum(low) - 1
        self.class_low = starts[group].astype(np.int32) if len(text) else starts
        self.class_high = np.r_[starts[1:], len(text)][group].astype(np.int32) if len(text) else starts

    def prepend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``word`` followed by what the intervals low..high stand for."""
        ranks = self.tree.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        begin = self.before[word]
        return begin + ranks[: len(word)], begin + ranks[len(word) :]

    def drop_last(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From intervals of ``depth`` words to those of their first ``depth`` - 1 words."""
        return self.class_low[low], self.class_high[low]


def matching_statistics(index: FMIndex, text: np.ndarray, ends: np.ndarray, lengths: np.ndarray):
    """For streamed sequences, the words of ``text`` that end at ``ends``: at every word, how many words from
    there on occur in the index, up to ``depth``, and the interval where ``depth`` words do.

    Yields (sequence, place, low, high) of the matches of ``depth`` words, a step of all sequences at a time:
    a search goes from the last word backwards, and once it has ``depth`` words it forgets the last one
    before it takes the next. A search whose interval becomes empty starts again behind the word
    that it failed at, with the longest match that is left.
    """
    depth = index.depth
    order = np.argsort(-lengths, kind="stable")
    ends, lengths = ends[order], lengths[order]
    low = np.zeros(len(order), dtype=np.int64)
    high = np.full(len(order), len(index.order), dtype=np.int64)
    matched = np.zeros(len(order), dtype=np.int64)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -step, "left"))  # those with more than ``step`` words
        word = text[ends[:live] - 1 - step]
        full = np.flatnonzero(matched[:live] == depth)
        low[full], high[full] = index.drop_last(low[full])
        matched[full] -= 1
        begin, end = index.prepend(word, low[:live], high[:live])
        for at in np.flatnonzero(begin >= end):  # rare: what is indexed is mostly what is streamed
            begin[at], end[at], matched[at] = _restart(index, text, int(ends[at]) - 1 - step, int(matched[at]))
        matched[:live] += 1
        low[:live], high[:live] = begin, end
        found = np.flatnonzero(matched[:live] == depth)
        if len(found):
            yield order[found], lengths[found] - 1 - step, low[found], high[found]


def _restart(index: FMIndex, text: np.ndarray, at: int, known: int) -> tuple[int, int, int]:
    """The interval of the longest match of fewer than ``known`` + 1 words that begins at ``at``, and its length
    less one; nothing matched is the whole index and -1."""
    for length in range(known, 0, -1):
        low, high = np.zeros(1, np.int64), np.full(1, len(index.order), np.int64)
        for place in range(at + length - 1, at - 1, -1):
            low, high = index.prepend(text[place : place + 1], low, high)
        if low[0] < high[0]:
            return int(low[0]), int(high[0]), length - 1
    return 0, len(index.order), -1
