"""Files of an n-gram trie, Elias-Fano coded and read through memory maps.

Words have ids in the order of their hashes. A vocabulary file holds a range of hashes: their Elias-Fano
sequence, and the running totals of their counts as another. A trie file holds the contexts of one
shard, last word first: a node of level k is a context of k words. Level by level it has
monotone pointers from each parent to its children; the children's words relative to their parent (parent *
universe + word, so that the sequence rises); monotone pointers from each node to its successors; the
successors relative to their node; and 10-bit codes of the smoothed log10 probability of each
successor and of each node's back-off weight. A query descends from the last word by
successor search between two pointers at every level.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs

from corvane.llm.eliasfano import EliasFano, encoded


def store_of(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def put(uri: str, content: bytes) -> None:
    """Writes a file whole or not at all."""
    store, path = store_of(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    store.move(own, path)


def opened(uri: str):  # noqa: ANN201
    """A buffer over a file: a memory map of a local one."""
    store, path = store_of(uri)
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    return store.open_input_file(path).read_buffer()


def find(sequence: EliasFano, wanted: np.ndarray) -> np.ndarray:
    """The position of each of the sorted wanted values, or -1."""
    place, same = sequence.successors(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), len(sequence), np.int64))
    return np.where(same, place, -1)


class Codes:
    """Values in 1024 equal steps from the least to the greatest, four to five bytes; a value is off by at most half a step."""

    @staticmethod
    def made(values: np.ndarray) -> bytes:
        low = float(values.min()) if len(values) else 0.0
        step = max((float(values.max()) - low) / 1023, 1e-12) if len(values) else 1.0
        code = np.zeros(-(-len(values) // 4) * 4, np.uint64)
        code[: len(values)] = np.rint((values - low) / step)
        four = code.reshape(-1, 4) << np.array([0, 10, 20, 30], np.uint64)
        packed = np.bitwise_or.reduce(four, axis=1).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        return np.array([low, step], "<f8").tobytes() + packed.tobytes()

    def __init__(self, buffer, at: int, n: int):  # noqa: ANN001
        self.low, self.step = np.frombuffer(buffer, "<f8", 2, at).tolist()
        self.bytes = np.frombuffer(buffer, np.uint8, -(-n // 4) * 5, at + 16)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        bit = (index & 3) * 10
        at = (index >> 2) * 5 + (bit >> 3)
        pair = self.bytes[at].astype(np.int64) | self.bytes[at + 1].astype(np.int64) << 8
        return self.low + self.step * (pair >> (bit & 7) & 1023)


def _joined(parts: list[bytes]) -> bytes:
    """Parts behind a table of their positions, each on 8 bytes."""
    at, table, out = 8 * (len(parts) + 1), [len(parts)], []
    for p in parts:
        table.append(at)
        p += bytes(-len(p) % 8)
        at += len(p)
        out.append(p)
    return np.array(table, "<u8").tobytes() + b"".join(out)


def _table(buffer) -> list[int]:  # noqa: ANN001
    n = int(np.frombuffer(buffer, "<u8", 1)[0])
    return np.frombuffer(buffer, "<u8", n, 8).tolist()


def word_level(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    totals = np.r_[0, np.cumsum(counts.astype(np.int64))]
    return _joined([encoded(hashes, (1 << 64) - 1), encoded(totals, int(totals[-1]))])


class WordLevel:
    """Ids (relative to the file) and counts of words by hash."""

    def __init__(self, buffer):  # noqa: ANN001
        at = _table(buffer)
        self.hashes, self.totals = EliasFano(buffer, at[0]), EliasFano(buffer, at[1])

    def look(self, hashes: np.ndarray) -> np.ndarray:
        return find(self.hashes, hashes)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        both = self.totals.select(np.r_[ids, ids + 1]).astype(np.int64)
        return both[len(ids) :] - both[: len(ids)]


@lru_cache(4096)
def vocabulary(path: str) -> WordLevel:
    """A vocabulary file, opened once in a worker's life."""
    return WordLevel(opened(path))


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where the rows of sorted columns differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values and each value's place among them; by a hash table, so that only the distinct are sorted."""
    held = pa.compute.dictionary_encode(pa.array(values))
    own, index = held.dictionary.to_numpy(), held.indices.to_numpy()
    order = np.argsort(own)
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own))
    return own[order], place[index]


def context_trie(grams: list[np.ndarray], counts: np.ndarray, universe: int, unigram, discount: float, whole: tuple[int, np.ndarray, np.ndarray] | None = None) -> bytes:  # noqa: ANN001
    """The file of sorted distinct grams (last context word, the one before, ..., next word) and their counts.

    Absolute discounting, each order over the next lower one: p(w|c) = max(n(c,w) - discount, 0) / n(c) + weight(c) p(w|c without its first
    word), weight(c) = discount * kinds(c) / n(c). unigram gives log10 probabilities of words. whole has one last word, all its
    successors and their counts, where the grams are only a part, or none, of those of that last word.
    """
    *context, word = (g.astype(np.int64) for g in grams)
    parts = [np.array([len(context), universe], "<u8").tobytes()]
    lower = 10 ** unigram(word)  # of each gram's word after the context of the level before
    node = np.zeros(len(word), np.int64)
    n_parents = 1
    for k in range(1, len(context) + 1):
        new = runs(context[:k])
        parent, node = node, np.cumsum(new) - 1
        n_nodes = int(new.sum())
        key, n = node * universe + word, counts.astype(np.int64)
        order = np.argsort(key) if k < len(context) else np.arange(len(key))
        key = key[order]
        first = runs([key])
        at, of_gram = np.flatnonzero(first), np.cumsum(first) - 1
        grams_key, key, n = key, key[at], np.add.reduceat(n[order], at) if len(at) else n
        below = lower[order][at]
        children, of = context[k - 1][new], parent[new]
        if k == 1 and whole is not None:
            children, of, n_nodes = np.array([whole[0]], np.int64), np.zeros(1, np.int64), 1
            key, n, below = whole[1].astype(np.int64), whole[2].astype(np.int64), 10 ** unigram(whole[1].astype(np.int64))
            of_gram = np.searchsorted(key, grams_key)
        own = key // universe
        total, kinds = np.bincount(own, n, minlength=n_nodes), np.bincount(own, minlength=n_nodes)
        weight = discount * kinds / np.maximum(total, 1)
        value = np.maximum(n - discount, 0) / total[own] + weight[own] * below if len(own) else np.zeros(0)
        lower = np.empty(len(word))
        lower[order] = value[of_gram]
        parts += [
            encoded(np.r_[0, np.cumsum(np.bincount(of, minlength=n_parents))], n_nodes),
            encoded(of * universe + children, max(n_parents, 1) * universe),
            encoded(np.r_[0, np.cumsum(kinds)], len(key)),
            encoded(key, max(n_nodes, 1) * universe),
            Codes.made(np.log10(value)),
            Codes.made(np.log10(weight)),
        ]
        n_parents = n_nodes
    return _joined(parts)


class ContextTrie:
    """Smoothed log10 probabilities after the contexts of a shard."""

    def __init__(self, buffer):  # noqa: ANN001
        at = _table(buffer)
        self.depth, self.universe = np.frombuffer(buffer, "<u8", 2, at[0]).tolist()
        self.levels = []
        for k in range(self.depth):
            child_pointers, children, pointers, successors = (EliasFano(buffer, at[1 + 6 * k + j]) for j in range(4))
            self.levels.append((child_pointers, children, pointers, successors, Codes(buffer, at[5 + 6 * k], len(successors)), Codes(buffer, at[6 + 6 * k], len(children))))

    def nodes(self, context: list[np.ndarray]) -> list[np.ndarray]:
        """For each level the node of each row's context, or -1; rows come sorted by their contexts."""
        out = []
        node = np.zeros(len(context[0]), np.int64)
        for k, (pointers, children, *_) in enumerate(self.levels):
            new = runs(context[: k + 1])
            heads = np.flatnonzero(new & (node >= 0))
            parent = node[heads]
            found = np.full(len(node), -1, np.int64)
            place, same = children.successors((parent * self.universe + context[k][heads]).astype(np.uint64), *pointers.ranges(parent))
            found[heads] = np.where(same, place, -1)
            head_of = np.flatnonzero(new)[np.cumsum(new) - 1]
            node = found[head_of]
            out.append(node)
        return out

    def log10(self, context: list[np.ndarray], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether it is all) for rows sorted by context: the probability at the longest context that has the word as a successor, times the weights
        of the longer ones; where none has it, the product of the weights alone."""
        value, done = np.zeros(len(word)), np.zeros(len(word), bool)
        for (_, _, pointers, successors, code, weight), node in zip(reversed(self.levels), reversed(self.nodes(context))):
            rows = np.flatnonzero((node >= 0) & ~done)
            wanted = (node[rows] * self.universe + word[rows]).astype(np.uint64)
            order = np.argsort(wanted, kind="stable")
            rows, wanted = rows[order], wanted[order]
            own = node[rows]
            place, same = successors.successors(wanted, *pointers.ranges(own))
            hit = rows[same]
            value[hit] += code[place[same]]
            done[hit] = True
            value[rows[~same]] += weight[own[~same]]
        return value, done
