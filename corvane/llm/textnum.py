"""Vectorised text primitives: words, word hashes and shingle sets of many texts at once.

A word is a run of bytes outside \\x20 and \\x09-\\x0D. These bytes never occur
inside a longer UTF-8 character, so bytes and characters agree. Hashes are 64
bits wide and depend on nothing but the bytes, so every task and every run
gives the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
#: Bytes whose powers are kept; longer stretches are hashed in windows.
WINDOW = 1 << 20
_powers: list[np.ndarray] = []


def _made(base: U, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if n > WINDOW:
        return _made(_BASE, n), _made(_BASE_INVERSE, n)
    if not _powers:
        _powers.extend(_made(base, WINDOW) for base in (_BASE, _BASE_INVERSE))
    return _powers[0][:n], _powers[1][:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; space: whether a byte is between words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~space[data]
    first = np.empty(len(data), bool)
    first[0], first[1:] = True, ~solid[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    first[borders] = True
    last = np.empty(len(data), bool)
    last[-1], last[:-1] = True, first[1:] | ~solid[1:]
    starts = np.flatnonzero(first & solid)
    ends = np.flatnonzero(last & solid) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: a polynomial in its bytes, mixed with its length. Words are in order and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(data) > WINDOW and len(starts) > 1:
        out, a = np.empty(len(starts), np.uint64), 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + WINDOW, side="right")))
            out[a:b] = word_hashes(data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
            a = b
        return out
    power, inverse = _power_tables(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[data] * power, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, A-Z lower-cased, and each row's first word."""
    data, offsets = column_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(column) + 1))


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each row its sorted distinct shingles of `width` words, as hashes.

    A row of fewer words has one shingle, the whole sequence; a row without words has none.
    """
    words, first = hashed_words(column)
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width if len(rolled) else 0):
        rolled = rolled * _BASE + words[k : k + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            found = np.sort(rolled[a : b - width + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif b > a:
            h = U(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _BASE + w
                out.append(mix(np.array([h ^ U(0xA5A5A5A5A5A5A5A5)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


#: Words whose text is put together at once.
JOINED = 1 << 20


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of words joined by one space: row i has the words numbered words[bounds[i] : bounds[i + 1]]."""
    sizes, last = ends[words] - starts[words] + 1, np.zeros(len(words), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    sizes -= last
    pieces = []
    for a in range(0, len(words), JOINED):
        size = sizes[a : a + JOINED]
        end = np.cumsum(size)
        at = np.arange(end[-1]) + np.repeat(starts[words[a : a + JOINED]] - (end - size), size)
        piece = data[np.minimum(at, len(data) - 1)]
        piece[end[~last[a : a + JOINED]] - 1] = 0x20
        pieces.append(piece)
    total = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(total[bounds].astype(np.int64)), pa.py_buffer(np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)))
