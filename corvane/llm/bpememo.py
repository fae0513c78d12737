"""Whole texts to token ids by the tokenizers library, with equal stretches encoded once.

A byte-level BPE splits a text into pieces before it merges, and no piece has a
single space inside or at its end unless other white space is beside it. So a
text falls apart, with the same ids, before each space that stands between two
other characters which are not white space. Natural text repeats such stretches
often; their ids are remembered as bytes of little-endian unsigned 32-bit numbers. The
memory is bounded: two generations of about HELD stretches each.

A stretch of letters is one piece, so it goes to the tokenizer's model without
being split again, its bytes spelled as the model's vocabulary spells them.

The library takes an added token's string out of a text before it splits, and
such a token may hold spaces or swallow those beside it. So a text that holds
one goes to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HELD = 300_000
#: Text bytes to encode at once: the more, the fewer different stretches for each of them.
ENCODED_BYTES = 3 << 20
#: The longest stretch that is remembered, in characters.
LONGEST = 64
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"[{_LATIN}]+")
#: Letters and then punctuation: no piece holds both.
_TAIL = re.compile(f"([{_LATIN}]+)([.,!?;:*$%&#]{{1,4}})")
_BREAK = re.compile(r"(?<=\S)(?= \S)")


def _spelling() -> dict[int, str]:
    """Latin letters as byte-level vocabularies spell their UTF-8 bytes: a byte that can't be shown is 256 and its rank among those."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    one = lambda b: chr(b) if b in shown else chr(256 + hidden.index(b))
    return {x: "".join(map(one, chr(x).encode())) for x in range(0xC0, 0x100)}


class MemoEncoder:
    """The ids of whole texts; what the library gives for each text, without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.bare = Tokenizer(self.tokenizer.model)
        self.spelling = _spelling()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:  # noqa: ANN001
        out = []
        for s in range(0, len(texts), 1024):
            out += [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts[s : s + 1024], add_special_tokens=False)]
        return out

    def _known(self, keys: list[str]) -> list[bytes | None]:
        """The ids of stretches by key: a stretch without the space it begins with; that of a text's first has a space more.

        None for a key with white space at an end: its text needs care. Such keys are never kept.
        """
        found: list[bytes | None] = list(map(self.new.get, keys))
        words: dict[str, int] = {}
        others: dict[str, int] = {}
        tailed: list[int] = []
        heads: list[str] = []
        ends: list[str] = []
        old, new, longest = self.old.get, self.new, LONGEST
        for i in [i for i, x in enumerate(found) if x is None]:
            k = keys[i]
            if (got := old(k)) is not None:
                found[i] = new[k] = got
            elif k.isalpha() and _WORD.fullmatch(k):
                words[k] = i
            elif m := _TAIL.fullmatch(k):
                tailed.append(i)
                heads.append(m[1])
                ends.append(m[2])
            else:
                own = k[1:] if k[:1] == " " else k
                if own and own.strip() == own:
                    others[k] = i
        known: dict[str, bytes] = {}
        for w in heads:
            if w not in words and w not in known:
                if got := new.get(w) or old(w):
                    known[w] = got
                else:
                    words[w] = -1
        for some, tokenizer, spelled in ((words, self.bare, ["Ġ" + (k if k.isascii() else k.translate(self.spelling)) for k in words]), (others, self.tokenizer, [k[1:] if k[:1] == " " else " " + k for k in others])):
            for (k, i), got in zip(some.items(), self._ids(tokenizer, spelled)):
                known[k] = got
                if i >= 0:
                    found[i] = got
                if len(k) <= longest:
                    new[k] = got
        for i, word, tail in zip(tailed, heads, ends):
            if tail not in self.tails:
                self.tails[tail] = self._ids(self.tokenizer, [tail])[0]
            found[i] = known[word] + self.tails[tail]
            if len(word) < longest:
                new[keys[i]] = found[i]
        return found

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids as unsigned 32-bit numbers, bounds) of a column of texts: text i has ids[bounds[i]:bounds[i + 1]]. A null is an empty text."""
        column = whole = column.fill_null("").cast(pa.string())
        added = self._with_added(column)
        if len(added):
            column = pc.if_else(pa.array(np.isin(np.arange(len(column)), added)), "", column)
        parts = pc.split_pattern(column, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        held = coded.dictionary
        # One string to Python and one split there: far cheaper than a string for each.
        words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), " ")[0].as_py().split(" ") if len(held) else []
        index = coded.indices.to_numpy().astype(np.int64)
        firsts, which = np.unique(index[at[:-1]], return_inverse=True)
        index[at[:-1]] = len(words) + which
        blobs = self._known(words + [" " + words[i] for i in firsts])
        care = np.zeros(0, np.int64)
        if None in blobs:
            bad = np.array([b is None for b in blobs])
            care = np.unique(np.searchsorted(at, np.flatnonzero(bad[index]), side="right") - 1)
            blobs = [b or b"" for b in blobs]
        pool = np.frombuffer(b"".join(blobs), "<u4")
        size = np.array(list(map(len, blobs)), np.int64) // 4
        start = np.cumsum(size) - size
        each = size[index]
        ends = np.r_[0, np.cumsum(each)]
        ids = pool[np.arange(ends[-1]) + np.repeat(start[index] - ends[:-1], each)]
        bounds = ends[at]
        if len(care) or len(added):
            own = np.split(ids, bounds[1:-1])
            for i in care.tolist():
                own[i] = np.frombuffer(self._careful(column[i].as_py()), "<u4")
            for i in added.tolist():
                own[i] = np.frombuffer(self._ids(self.tokenizer, [whole[i].as_py()])[0], "<u4")
            ids, bounds = np.concatenate(own), np.r_[0, np.cumsum([len(x) for x in own])]
        if len(self.new) > HELD:
            self.old, self.new = self.new, {}
        return ids, bounds

    def _with_added(self, column: pa.Array) -> np.ndarray:
        """Which texts hold an added token's string."""
        found = np.zeros(len(column), bool)
        for token in self.added:
            found |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found)

    def _careful(self, text: str) -> bytes:
        """A text with white space beside a space, or with none at all."""
        if not text:
            return b""
        first, *rest = _BREAK.split(text)
        keys = [" " + first, *(x[1:] for x in rest)]
        found = self._known(keys)
        return b"".join(x if x is not None else self._ids(self.tokenizer, [k[1:] if k[:1] == " " else " " + k])[0] for k, x in zip(keys, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


_encoders: dict[str, MemoEncoder] = {}


def encoder(path: str) -> MemoEncoder:
    """This process's encoder of that file; a worker keeps it from task to task."""
    if path not in _encoders:
        _encoders[path] = MemoEncoder(path)
    return _encoders[path]
