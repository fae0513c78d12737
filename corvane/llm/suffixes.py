"""Suffix arrays of word ids by prefix doubling, and the counts of n-grams from intervals of the common prefixes."""

from __future__ import annotations

import numpy as np


def dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and each one's rank from 1, equal ones alike."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.r_[True, held[1:] != held[:-1]]) if len(keys) else 0
    return order, rank


def suffix_order(ids: np.ndarray, left: np.ndarray, most: int) -> np.ndarray:
    """Positions in the order of the next `most` or more ids, of which a suffix at i has left[i] at most; shorter ones first.

    Ids are 0 or more. Each round doubles the length that ranks stand for: the rank of a suffix and that of the one
    behind it make one number.
    """
    order, rank = dense(ids)
    width = 1
    while width < most:
        more = np.flatnonzero(left > width)
        second = np.zeros(len(ids), np.int64)
        second[more] = rank[more + width]
        order, rank = dense(rank * (len(ids) + 1) + second)
        width *= 2
    return order


def common_prefixes(ids: np.ndarray, left: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in order, how many ids it shares with the one before, `most` at most; 0 for the first."""
    out = np.zeros(len(order), np.int8)
    same = np.arange(1, len(order))
    for n in range(most):
        a, b = order[same - 1], order[same]
        longer = (left[a] > n) & (left[b] > n)
        same, a, b = same[longer], a[longer], b[longer]
        same = same[ids[a + n] == ids[b + n]]
        out[same] += 1
    return out


def ngrams(left: np.ndarray, order: np.ndarray, prefixes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams: where each interval begins in order, its first position and its size. An interval ends where fewer than n ids are shared."""
    begins = np.flatnonzero(prefixes < n)
    sizes = np.diff(np.r_[begins, len(order)])
    full = left[order[begins]] >= n
    return begins[full], order[begins[full]], sizes[full]
