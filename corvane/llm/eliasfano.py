"""Elias-Fano coding of monotone sequences, with select and successor search.

A value of a sequence of n values below u has its low bits stored plainly and
its high bits in unary: bit (high + i) is set for the i-th value. This takes
about 2 + log2(u / n) bits a value. A sample of the positions of set bits makes
select cheap; everything is read from one buffer, which may be a memory map.

Layout, little endian: 8 bytes each of n, low width, number of high words,
number of samples; then the low bits (64-bit words and one of padding), the high
words and the samples (position of each set bit number k * SAMPLE).
"""

from __future__ import annotations

import numpy as np

SAMPLE = 512
_HEAD = 32
#: Blocks of SAMPLE values that are decoded together.
BLOCKS = 2048


def encoded(values: np.ndarray, universe: int) -> bytes:
    """The sorted non-negative values, all at most universe, as bytes."""
    values = values.astype(np.uint64)
    n = len(values)
    width = max(0, int(universe // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(((int(high[-1]) if n else 0) // 64 + 1) * 64, bool)
    bits[high] = True
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    low = np.zeros(n * width // 64 + 2, np.uint64)
    if width:
        part = values & np.uint64((1 << width) - 1)
        at = np.arange(n, dtype=np.int64) * width
        shift = (at & 63).astype(np.uint64)
        np.bitwise_or.at(low, at >> 6, part << shift)
        over = (at & 63) + width > 64
        np.bitwise_or.at(low, (at[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
    samples = high[::SAMPLE].astype(np.uint64)
    return np.array([n, width, len(words), len(samples)], np.uint64).tobytes() + low.tobytes() + words.tobytes() + samples.tobytes()


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct of sorted values."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


class EliasFano:
    """Reads what encoded() made, from offset `at` of a buffer. `end` is the offset behind it."""

    def __init__(self, buffer, at: int = 0):
        head = np.frombuffer(buffer, np.uint64, 4, at)
        self.n, self.width, n_words, n_samples = map(int, head)
        n_low = self.n * self.width // 64 + 2
        self.low = np.frombuffer(buffer, np.uint64, n_low, at + _HEAD)
        self.high = np.frombuffer(buffer, np.uint64, n_words, at + _HEAD + 8 * n_low)
        self.samples = np.frombuffer(buffer, np.uint64, n_samples, at + _HEAD + 8 * (n_low + n_words))
        self.end = at + _HEAD + 8 * (n_low + n_words + n_samples)

    def __len__(self) -> int:
        return self.n

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        shift = (at & 63).astype(np.uint64)
        out = self.low[at >> 6] >> shift
        over = (at & 63) + self.width > 64
        out[over] |= self.low[(at[over] >> 6) + 1] << (np.uint64(64) - shift[over])
        return out & np.uint64((1 << self.width) - 1)

    def values(self, start: int, stop: int) -> np.ndarray:
        """Values start to stop - 1, by one pass over their bits."""
        stop = min(stop, self.n)
        if start >= stop:
            return np.zeros(0, np.uint64)
        first = int(self.samples[start // SAMPLE])
        last = int(self.samples[(stop - 1) // SAMPLE + 1]) if (stop - 1) // SAMPLE + 1 < len(self.samples) else len(self.high) * 64 - 1
        block = self.high[first >> 6 : (last >> 6) + 1]
        ones = np.flatnonzero(np.unpackbits(block.view(np.uint8), bitorder="little")) + (first >> 6 << 6)
        ones = ones[np.searchsorted(ones, first) :][start % SAMPLE :][: stop - start]
        index = np.arange(start, stop)
        return (ones - index).astype(np.uint64) << np.uint64(self.width) | self._low(index)

    def select_samples(self) -> np.ndarray:
        """Every SAMPLE-th value."""
        index = np.arange(len(self.samples), dtype=np.int64) * SAMPLE
        return (self.samples.astype(np.int64) - index).astype(np.uint64) << np.uint64(self.width) | self._low(index)

    def decoded(self, blocks: np.ndarray) -> np.ndarray:
        """The values of these blocks of SAMPLE, ascending and each once, one after the other: only their bits are looked at."""
        first = self.samples[blocks].astype(np.int64)
        end = np.full(len(blocks), len(self.high) * 64, np.int64)
        inner = blocks + 1 < len(self.samples)
        end[inner] = self.samples[blocks[inner] + 1]
        begin, count = first >> 6, ((end - 1) >> 6) - (first >> 6) + 1
        at = np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        ones = np.flatnonzero(np.unpackbits(self.high[at].view(np.uint8), bitorder="little"))
        block, ones = np.repeat(np.arange(len(blocks)), count)[ones >> 6], at[ones >> 6] * 64 + (ones & 63)
        keep = (ones >= first[block]) & (ones < end[block])
        held = np.minimum(SAMPLE, self.n - blocks * SAMPLE)
        index = np.repeat(blocks * SAMPLE - np.r_[0, np.cumsum(held)[:-1]], held) + np.arange(held.sum())
        return (ones[keep] - index).astype(np.uint64) << np.uint64(self.width) | self._low(index)

    def select(self, index: np.ndarray) -> np.ndarray:
        """The values at these positions, in any order."""
        index = np.asarray(index, np.int64)
        out = np.empty(len(index), np.uint64)
        order = np.argsort(index >> 9, kind="stable")
        block = index[order] >> 9
        touched = _distinct(block)
        for s in range(0, len(touched), BLOCKS):
            some = touched[s : s + BLOCKS]
            a, b = np.searchsorted(block, [some[0], some[-1] + 1])
            own = order[a:b]
            out[own] = self.decoded(some)[(np.searchsorted(some, block[a:b]) << 9) + (index[own] & (SAMPLE - 1))]
        return out

    def ranges(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at sorted positions and at the positions after them: where the children of nodes begin and end."""
        new = np.ones(len(index), bool)
        np.not_equal(index[1:], index[:-1], out=new[1:])
        some, of = index[new], np.cumsum(new) - 1
        values = self.select(np.r_[some, some + 1]).astype(np.int64)
        return values[: len(some)][of], values[len(some) :][of]

    def successors(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the sorted wanted values the first position in [begin, end) whose value is at least it, or end, and whether it is that value.

        The sequence must rise strictly.
        """
        place, same = end.astype(np.int64), np.zeros(len(wanted), bool)
        own = np.flatnonzero(begin < end)
        if not len(own):
            return place, same
        # The last block of the range whose first value is at most the wanted one holds the successor or ends before it.
        block = np.clip(np.searchsorted(self.select_samples(), wanted[own], side="right") - 1, begin[own] >> 9, (end[own] - 1) >> 9)
        touched = _distinct(block)
        for s in range(0, len(touched), BLOCKS):
            some = touched[s : s + BLOCKS]
            a, b = np.searchsorted(block, [some[0], some[-1] + 1])
            values = self.decoded(some)
            home = np.cumsum(np.r_[0, block[a + 1 : b] != block[a : b - 1]])
            k = np.clip(np.searchsorted(values, wanted[own[a:b]]), home << 9, (home + 1) << 9)
            at = np.clip(block[a:b] * SAMPLE + k - (home << 9), begin[own[a:b]], end[own[a:b]])
            k = at - block[a:b] * SAMPLE + (home << 9)
            place[own[a:b]] = at
            same[own[a:b]] = (at < end[own[a:b]]) & (k < len(values)) & (values[np.minimum(k, len(values) - 1)] == wanted[own[a:b]])
        return place, same
        # The last block of the range whose first value is at most the wanted one holds the successor or ends before it.
        block = np.clip(np.searchsorted(self.select_samples(), wanted[own], side="right") - 1, begin[own] >> 9, (end[own] - 1) >> 9)
        touched = _distinct(block)
        for s in range(0, len(touched), BLOCKS):
            some = touched[s : s + BLOCKS]
            a, b = np.searchsorted(block, [some[0], some[-1] + 1])
            values = self.decoded(some)
            k = np.searchsorted(values, wanted[own[a:b]])
            home = np.cumsum(np.r_[0, block[a + 1 : b] != block[a : b - 1]])
            k = np.clip(k, home << 9, np.minimum((home + 1) << 9, len(values)))
            at = block[a:b] * SAMPLE + k - (home << 9)
            at = np.clip(at, begin[own[a:b]], end[own[a:b]])
            inside = (at < end[own[a:b]]) & (k < len(values))
            place[own[a:b]] = at
            same[own[a:b]] = inside & (values[np.minimum(k, len(values) - 1)] == wanted[own[a:b]])
        return place, same

    def all(self) -> np.ndarray:
        return self.values(0, self.n)
