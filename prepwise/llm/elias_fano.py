"""Elias-Fano coding of monotone sequences as plain arrays that can be memory-mapped."""
from __future__ import annotations

import numpy as np

_FIVES, _THREES, _FIFTEENS, _EACH, _TOPS = (np.uint64(x * 0x0101010101010101) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))
#: Place of each set bit in each byte.
_PLACES = np.array([([k for k in range(8) if byte >> k & 1] + [0] * 8)[:8] for byte in range(256)], np.int64).ravel()
_ONE, _SIX, _MASK6 = np.uint64(1), np.uint64(6), np.uint64(63)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of every value, one after another (one spare word at the end)."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width:
        bit = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (bit >> _SIX).astype(np.int64), bit & _MASK6
        np.bitwise_or.at(words, word, values << shift)
        spill = (shift + np.uint64(width)) > np.uint64(64)
        np.bitwise_or.at(words, word[spill] + 1, values[spill] >> (np.uint64(64) - shift[spill]))
    return words


def _unpack(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    bit = index.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> _SIX).astype(np.int64), bit & _MASK6
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & _MASK6), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1)


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the ``rank``-th set bit (from 0) of each word."""
    rank = rank.astype(np.uint64)
    # set bits of each byte and those before it, then the byte, then the place in it
    sums = words - ((words >> np.uint64(1)) & _FIVES)
    sums = (sums & _THREES) + ((sums >> np.uint64(2)) & _THREES)
    sums = ((sums + (sums >> np.uint64(4))) & _FIFTEENS) * _EACH
    place = np.minimum(np.bitwise_count(((rank * _EACH | _TOPS) - sums) & _TOPS), 7).astype(np.uint64) << np.uint64(3)
    inside = np.minimum(rank - ((sums << np.uint64(8)) >> place & np.uint64(255)), np.uint64(7))
    return place.astype(np.int64) + _PLACES[((words >> place & np.uint64(255)) << np.uint64(3) | inside).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of unsigned numbers: ``width`` low bits packed, the rest unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones
        self.zeros = None

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, places >> 6, _ONE << (places & 63).astype(np.uint64))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        return cls(n, width, _pack(values & np.uint64((1 << width) - 1), width), high, ones)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"meta": np.array([self.n, self.width], np.int64), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def of(cls, get) -> EliasFano:
        """From ``get(name)`` that returns the stored arrays."""
        n, width = (int(x) for x in get("meta"))
        return cls(n, width, get("low"), get("high"), get("ones"))

    def access(self, index: np.ndarray) -> np.ndarray:
        """Values at the places ``index``."""
        index = np.asarray(index, np.int64)
        word = np.searchsorted(self.ones, index, side="right") - 1
        place = word * 64 + _select_in_word(self.high[word], index - self.ones[word])
        return ((place - index).astype(np.uint64) << np.uint64(self.width)) | _unpack(self.low, index, self.width)

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of the ``rank``-th zero bit; past the last one, as if only zeros followed."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.minimum(np.searchsorted(self.zeros, rank, side="right") - 1, len(self.high))
        inside = np.minimum(word, len(self.high) - 1)
        place = word * 64 + np.where(word < len(self.high), _select_in_word(~self.high[inside], np.minimum(rank - self.zeros[inside], 63)), rank - self.zeros[-1])
        return place

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value in the sequence, -1 where it is not (for strictly rising sequences)."""
        values = np.asarray(values, np.uint64)
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        top = (values >> np.uint64(self.width)).astype(np.int64)
        # elements with this upper part, [first, last): the ones between two zeros, most often of one word
        start = np.where(top > 0, self._zero(np.maximum(top - 1, 0)) + 1, 0)
        first = np.minimum(start - top, self.n)
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        zeros = ~(self.high[np.minimum(word, len(self.high) - 1)] >> shift)
        run = np.bitwise_count((zeros & (~zeros + _ONE)) - _ONE).astype(np.int64)
        last = np.where(word < len(self.high), first + run, first)
        over = np.flatnonzero((word < len(self.high)) & (run + (start & 63) >= 64))
        last[over] = np.minimum(self._zero(top[over]) - top[over], self.n)
        want = values & np.uint64((1 << self.width) - 1)
        low, high = first.copy(), last.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = _unpack(self.low, middle, self.width) < want[open_]
            low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
            open_ = open_[low[open_] < high[open_]]
        held = low < last
        held[held] = _unpack(self.low, low[held], self.width) == want[held]
        return np.where(held, low, -1)
