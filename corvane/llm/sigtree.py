"""Signature trees over sets: OR-combined token bitmaps and size ranges, joined by dual traversal.

A set's bitmap has bit (token mod width) set for each of its tokens. A node
holds the OR of its sets' bitmaps, their smallest and largest size, and the
largest `slack`, the number of tokens of a set beyond its set bits. Two sets
below nodes A and B share at most

    min(largest size of A, of B, bits of (A and B) + min(slack of A, of B))

tokens. A pair of nodes is dropped when that is less than the overlap which
two sets of the smallest sizes there need for the wanted similarity.
"""

from __future__ import annotations

import numpy as np

FANOUT = 16


def width_for(n: int) -> int:
    """Bits of a bitmap for sets of up to n tokens: a power of two, at least twice n."""
    return max(256, 1 << (2 * n - 1).bit_length())


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    """The bitmap as 64-bit words."""
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap made narrower; the bits are those of bitmap(tokens, width)."""
    return np.bitwise_or.reduce(words.reshape(-1, width // 64), axis=0)


def needed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least overlap of sets of sizes a and b whose Jaccard similarity is num/den or more."""
    return -(-num * (a + b) // (num + den))


def most_shared(n: int, x: bytes, m: int, y: bytes) -> int:
    """The most tokens that two sets of n and m tokens with these bitmaps can share: each lone bit is a token without a partner."""
    width = 8 * min(len(x), len(y))
    a, b = folded(np.frombuffer(x, np.uint64), width), folded(np.frombuffer(y, np.uint64), width)
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


class SignatureTree:
    """A packed tree: each level groups FANOUT neighbours of the one below, leaves in the given order."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, classes: np.ndarray):
        slack = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, slack, classes, classes)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack, first, last = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))


def _kept(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which node pairs (i of x, j of y) may hold a wanted pair of sets of different classes."""
    step = max(64, (1 << 18) // x[0].shape[1])
    keep = np.empty(len(i), bool)
    for s in range(0, len(i), step):
        a, b = i[s : s + step], j[s : s + step]
        low = needed(x[1][a], y[1][b], num, den)
        most = np.minimum(x[2][a], y[2][b])
        ok = (most >= low) & ((x[4][a] != x[5][a]) | (y[4][b] != y[5][b]) | (x[4][a] != y[4][b]))
        at = np.flatnonzero(ok)
        shared = np.bitwise_count(x[0][a[at]] & y[0][b[at]]).sum(axis=1, dtype=np.int64)
        ok[at] = shared + np.minimum(x[3][a[at]], y[3][b[at]]) >= low[at]
        keep[s : s + step] = ok
    return keep


def dual_join(x: SignatureTree, y: SignatureTree | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of leaves that remain; y None: pairs within x, each once."""
    own, y = y is None, y or x
    i = j = np.zeros(1, np.int64)
    depth_x, depth_y = len(x.levels) - 1, len(y.levels) - 1
    if not len(x.levels[0][0]) or not len(y.levels[0][0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        keep = _kept(x.levels[depth_x], y.levels[depth_y], i, j, num, den)
        i, j = i[keep], j[keep]
        if depth_x == 0 and depth_y == 0:
            if own:
                keep = i < j
                i, j = i[keep], j[keep]
            return i, j
        if depth_x >= depth_y and depth_x:
            depth_x -= 1
            i, j = _below(i, j, len(x.levels[depth_x][0]))
        if depth_y > depth_x or own:
            depth_y -= 1
            j, i = _below(j, i, len(y.levels[depth_y][0]))
        if own:
            keep = i <= j
            i, j = i[keep], j[keep]


def _below(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Replaces nodes i by their children, n at that level, beside the same j."""
    child = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    keep = child < n
    return child[keep], np.repeat(j, FANOUT)[keep]
