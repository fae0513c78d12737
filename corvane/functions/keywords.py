"""Counts of many keyword lists in one pass over a text, by an automaton over all their words.

text.mentions() is one pass of a regular expression for each list, which is the better choice for a few lists; a taxonomy has forty and more.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import normalized

_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@lru_cache(maxsize=8)
def automaton(lists: tuple[tuple[str, ...], ...]) -> ahocorasick.Automaton:
    """An automaton of all words as normalize_text() leaves them; a word's value is its length and its (list, place in it)s. Made once a worker."""
    owners: dict[str, list[tuple[int, int]]] = {}
    for k, words in enumerate(lists):
        for place, word in enumerate(words):
            if word.strip():
                owners.setdefault(normalized(word), []).append((k, place))
    out = ahocorasick.Automaton()
    for word, own in owners.items():
        out.add_word(word, (len(word), own))
    out.make_automaton()
    return out


def counted(text: str, lists: tuple[tuple[str, ...], ...]) -> list[int]:
    """How often any word of each list occurs as whole words, without overlaps within a list: from the left, and at a place the first of the list that fits."""
    counts, ends = [0] * len(lists), [0] * len(lists)
    own = automaton(lists)
    if not text or own.kind != ahocorasick.AHOCORASICK:
        return counts
    n, hits = len(text), []
    for last, (size, owners) in own.iter(text):
        start = last + 1 - size
        if (last + 1 == n or text[last + 1] not in _INNER) and (not start or text[start - 1] not in _INNER):
            hits += [(start, k, place, last + 1) for k, place in owners]
    hits.sort()
    for start, k, _, end in hits:  # of the words of a list at one place the first comes first
        if start >= ends[k]:
            counts[k] += 1
            ends[k] = end
    return counts


def counts(normal: Column, lists: Iterable[Iterable[str]]) -> Column:
    """array<int>: counted() of normalised text for each list; null counts as empty."""
    held = tuple(tuple(words) for words in lists)

    @F.pandas_udf("array<int>")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: counted(t or "", held))

    return count(normal)
