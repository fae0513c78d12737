"""LM scoring: an n-gram model from all training texts, kept in Elias-Fano tries and asked by shard.

Three passes over whole texts: word counts, gram counts, requests. Each task counts
what it has read before it sends anything, as packed sorted columns, one blob for each
shard. A gram's shard follows its last context word, so that the shard's task has all
orders of it: it merges the grams of the highest order, derives the lower ones and writes a trie
to the shared folder. To score, tasks send each token with its context and row to
the shard, whose task opens its trie once, descends it for all of them and sends back one sum
for each row. The contexts of very frequent words are spread over several shards by the word before, and the
word's successors are counted on their own. The number of shards follows the counted tokens, so a
shard's task has about as much to do whatever the size of the corpus; a shard that is asked more than
others is asked by several tasks. The driver sees a row for each file and the few very frequent words;
what it broadcasts is some bytes for each shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import lmtrie
from corvane.llm.common import as_batch, by_arrow, freed, new_path, partitions, returned, text_slices, transient, tuned
from corvane.llm.textnum import U, hashed_words, mix

#: The hash of the token that ends each text; words' hashes are mixed and never take it in practice.
END = U(0x656E646F66646F63)
#: Tokens that a task gathers before it counts or sends them together, and requests that a shard answers together.
GATHERED, ANSWERED = 1_400_000, 1_600_000
#: Words of the longest n-gram.
ORDER = 3
DISCOUNT = 0.75
#: Training tokens that a shard of contexts has, unless there are fewer of them for each partition.
TOKENS_A_SHARD = 4_000_000
#: Least number of shards for the contexts that end with a very frequent word, and the words that a file names at least as candidates.
SPREAD, FREQUENT = 16, 64


def held_out(id_column: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether crc32 of the id's decimal text leaves that remainder; a null id isn't held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of equal length by byte planes, compressed: the first, which must be sorted, as differences; only planes that hold something."""
    out = [np.array([len(columns), len(columns[0])], "<u8").tobytes()]
    for i, c in enumerate(columns):
        c = np.ascontiguousarray(c, "<u8")
        c = np.diff(c, prepend=U(0)) if i == 0 else c
        wide = (int(c.max(initial=0)).bit_length() + 7) // 8
        out += [bytes([wide]), np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(blob: bytes) -> list[np.ndarray]:
    blob = zstandard.ZstdDecompressor().decompress(blob)
    n_columns, n = np.frombuffer(blob, "<u8", 2).tolist()
    out, at = [], 16
    for i in range(n_columns):
        wide = blob[at]
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :wide] = np.frombuffer(blob, np.uint8, wide * n, at + 1).reshape(wide, n).T
        at += 1 + wide * n
        c = whole.view("<u8").ravel()
        out.append(np.cumsum(c, dtype=np.uint64) if i == 0 else c)
    return out


def _key(columns: list[np.ndarray]) -> tuple[np.ndarray | None, list[int], list[int]]:
    """The columns as one number that sorts as they do, their least values and bits; None if 64 bits are too few."""
    low = [int(c.min(initial=0)) if len(c) == 0 else int(c.min()) for c in columns]
    bits = [(int(c.max()) - m).bit_length() if len(c) else 0 for c, m in zip(columns, low)]
    if sum(bits) > 64:
        return None, low, bits
    key = np.zeros(len(columns[0]), np.uint64)
    for c, m, b in zip(columns, low, bits):
        key = (key << U(b) if b < 64 else key) | (c - U(m))
    return key, low, bits


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """A sorting order by all columns."""
    key, _, _ = _key(columns)
    return np.argsort(key) if key is not None else np.lexsort(columns[::-1])


def _sums(columns: list[np.ndarray], counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of the columns, sorted, and the sums of their counts (None: ones)."""
    key, low, bits = _key(columns)
    if key is None:
        order = np.lexsort(columns[::-1])
        columns, counts = [c[order] for c in columns], None if counts is None else counts[order]
        at = np.flatnonzero(lmtrie.runs(columns))
        n = np.diff(np.r_[at, len(order)]).astype(np.uint64) if counts is None else np.add.reduceat(counts, at)
        return [c[at] for c in columns], n
    key, n = summed(key, counts)
    out = []
    for m, b in zip(reversed(low), reversed(bits)):
        out.append((key & U((1 << b) - 1)) + U(m))
        key = key >> U(b) if b < 64 else np.zeros_like(key)
    return out[::-1], n


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts (None: ones)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.r_[at, len(keys)]).astype(np.uint64) if counts is None else np.add.reduceat(counts, at) if len(at) else counts


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, token hashes, first token of each row): rows of about GATHERED tokens, each row with its end."""
    ids, hashes, ends, held = [], [], [], 0

    def out() -> tuple:
        flat = np.concatenate(hashes)
        return pa.concat_arrays(ids), flat, np.r_[0, np.concatenate(ends).cumsum()]

    for part in text_slices(batches, "text"):
        words, first = hashed_words(part.column(1))
        flat = np.insert(words, first[1:], END)
        ids.append(part.column(0))
        hashes.append(flat)
        ends.append(np.diff(first) + 1)
        held += len(flat)
        if held >= GATHERED:
            yield out()
            ids, hashes, ends, held = [], [], [], 0
    if ids:
        yield out()


def _by_shard(columns: list[np.ndarray], shard: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The rows of each shard, packed."""
    at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
    for a, b in zip(at, np.r_[at[1:], len(shard)]):
        yield int(shard[a]), packed([c[a:b] for c in columns])


def _merged(blobs: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """The sums of blobs whose last column is a count, merged some at a time."""
    rows: list[np.ndarray] = []
    counts = np.zeros(0, np.uint64)
    pending: list[list[np.ndarray]] = []
    size = 0
    for i, blob in enumerate(blobs):
        pending.append(unpacked(blob.as_py()))
        size += len(pending[-1][0])
        if size > max(1_000_000, len(counts)) or i == len(blobs) - 1:
            held = [*([[*rows, counts]] if rows else []), *pending]
            *columns, n = (np.concatenate([h[k] for h in held]) for k in range(len(held[0])))
            rows, counts = _sums(columns, n)
            pending, size = [], 0
    return rows, counts


@dataclass
class Model:
    """Where the files are, and the totals: a row for each file, whatever the corpus."""

    order: int
    word_bits: int
    word_files: list[str | None]
    word_base: np.ndarray
    words: int
    tokens: int
    #: Shards of contexts that don't end with a very frequent word.
    shards: int
    #: Very frequent words, sorted, and the shards of those that need more than SPREAD of them.
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    widths: dict[int, int] = field(default_factory=dict)
    #: Where the tries are, the sorted numbers of those that exist, and the tasks that are asked for a shard with more than its share.
    folder: str = ""
    tries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    askers: dict[int, int] = field(default_factory=dict)

    @property
    def begins(self) -> np.ndarray:
        """The first shard of each very frequent word, and the one after the last."""
        return self.shards + np.r_[0, np.cumsum([self.widths.get(w, SPREAD) for w in self.frequent.tolist()], dtype=np.int64)]

    def trie(self, shard: int) -> str | None:
        """The file of a shard's trie, if it has one."""
        at = np.searchsorted(self.tries, shard)
        return f"{self.folder}/tries-{shard:06d}" if at < len(self.tries) and self.tries[at] == shard else None

    def look(self, hashes: np.ndarray, *, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts (if asked for, else zeros) of sorted hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes >> U(64 - self.word_bits)).astype(np.int64) if self.word_bits else np.zeros(len(hashes), np.int64)
        border = np.searchsorted(shard, np.arange(len(self.word_files) + 1))
        for s, path in enumerate(self.word_files):
            a, b = border[s], border[s + 1]
            if path and a < b:
                level = lmtrie.vocabulary(path)
                at = level.look(hashes[a:b])
                known = np.flatnonzero(at >= 0)
                ids[a + known] = at[known] + self.word_base[s]
                if counted:
                    counts[a + known] = level.counts(at[known])
        return ids, counts

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))

    def unigram_of(self, ids: np.ndarray) -> np.ndarray:
        """log10 unigram probabilities by id; an id beyond the words is an unknown one."""
        distinct, inverse = lmtrie.distinct(ids.astype(np.int64))
        counts = np.zeros(len(distinct), np.int64)
        border = np.searchsorted(distinct, self.word_base)
        for s, path in enumerate(self.word_files):
            a, b = border[s], border[s + 1]
            if path and a < b:
                counts[a:b] = lmtrie.vocabulary(path).counts(distinct[a:b] - self.word_base[s])
        return self.unigram(counts)[inverse]

    def shard_of(self, last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        """The shard of contexts by their last word and, for a very frequent one, the word before."""
        out = (last // U(-(-(self.words + 2) // self.shards))).astype(np.int64)
        if len(self.frequent) and before is not None:
            place = np.minimum(np.searchsorted(self.frequent, last), len(self.frequent) - 1)
            often = np.flatnonzero(self.frequent[place] == last)
            begins, place = self.begins, place[often]
            out[often] = begins[place] + (mix(before[often]) % np.diff(begins).astype(np.uint64)[place]).astype(np.int64)
        return out

    def columns(self, ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """(last context word, the ones before, next word) of each token; the number of words stands for a text's begin."""
        place = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
        out = []
        for k in range(1, self.order):
            c = np.full(len(ids), self.words, np.uint64)
            c[k:] = ids[:-k]
            c[place < k] = self.words
            out.append(c)
        return [*out, ids]


class Known:
    """What a task has looked up: of each gather only the words that are new are looked for."""

    def __init__(self, model: Model, *, counted: bool):
        self.model, self.counted = model, counted
        self.hashes, self.ids, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def tokens(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of tokens; the id of an unknown word is the number of words and one."""
        distinct, inverse = lmtrie.distinct(hashes)
        at = np.searchsorted(self.hashes, distinct)
        held = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        held[inside] = self.hashes[at[inside]] == distinct[inside]
        new = distinct[~held]
        ids, counts = self.model.look(new, counted=self.counted)
        ids = np.where(ids >= 0, ids, self.model.words + 1).astype(np.uint64)
        spot = np.searchsorted(self.hashes, new)
        self.hashes, self.ids, self.counts = np.insert(self.hashes, spot, new), np.insert(self.ids, spot, ids), np.insert(self.counts, spot, counts)
        own = np.searchsorted(self.hashes, distinct)[inverse]
        return self.ids[own], self.counts[own]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _vocabulary(rows: DataFrame, order: int, folder: str) -> Model:
    bits = max(0, (partitions(rows.sparkSession) - 1).bit_length())
    enough = TOKENS_A_SHARD // 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, _ in _gathered(batches):
            keys, counts = summed(hashes)
            blobs = list(_by_shard([keys, counts], (keys >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)))
            yield as_batch({"shard": pa.array([s for s, _ in blobs], pa.int32()), "blob": pa.array([b for _, b in blobs], pa.binary())})

    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        (hashes,), counts = _merged(table.column("blob"))
        lmtrie.put(path := f"{folder}/words-{shard:06d}", lmtrie.word_level(hashes, counts))
        often = np.argsort(counts, kind="stable")[::-1][: max(FREQUENT, int((counts > enough).sum()))]
        return pa.table({"shard": pa.array([shard], pa.int32()), "path": [path], "n": pa.array([len(hashes)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()), "often": pa.array([often.tolist()], pa.list_(pa.int64())), "counts": pa.array([counts[often].tolist()], pa.list_(pa.int64()))})

    made = "shard int, path string, n long, total long, often array<long>, counts array<long>"
    files = {r["shard"]: r for r in by_arrow(rows, count, "shard int, blob binary").groupBy("shard").applyInArrow(write, made).collect()}
    n_files = 1 << bits
    each = [files[s]["n"] if s in files else 0 for s in range(n_files)]
    base, tokens = np.r_[0, np.cumsum(each)], sum(r["total"] for r in files.values())
    model = Model(order, bits, [files[s]["path"] if s in files else None for s in range(n_files)], base, sum(each), tokens, max(n_files, -(-tokens // TOKENS_A_SHARD)), folder=folder)
    if order > 2 and model.shards > 1:
        # At most as many words as shards have more than a shard's share of all tokens.
        often = {int(base[s]) + i: n * model.shards / tokens for s, r in files.items() for i, n in zip(r["often"], r["counts"]) if n * model.shards > tokens}
        model.frequent = np.array(sorted(often), np.uint64)
        model.widths = {w: math.ceil(share) for w, share in often.items() if share > SPREAD}
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, order: int = ORDER, folder: str | None = None, discount: float = DISCOUNT) -> Model:
    """Counts all of docs and writes vocabulary and tries of grams of up to `order` words, 2 or more.

    A null text is an empty one: its only token is the end. Without a folder the files lie in the shared one until the driver ends.
    """
    spark = docs.sparkSession
    tuned(spark)
    path = folder or new_path(spark, "trie")
    rows = _rows(docs, id_col, text_col)
    model = _vocabulary(rows, order, path)
    held = spark.sparkContext.broadcast(model)
    begins = model.begins
    universe, spread = model.words + 2, int(begins[-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        known = Known(m, counted=False)
        for _, hashes, first in _gathered(batches):
            grams, n = _sums(m.columns(known.tokens(hashes)[0], first), None)
            del hashes
            shard = m.shard_of(grams[0], grams[1] if order > 2 else None)
            by = np.argsort(shard, kind="stable")
            blobs = list(_by_shard([*(g[by] for g in grams), n[by]], shard[by]))
            # The successors of very frequent words, whatever stands before them.
            some = np.flatnonzero(shard >= m.shards)
            if len(some):
                pairs, n = _sums([grams[0][some], grams[-1][some]], n[some])
                blobs += _by_shard([*pairs, n], spread + np.searchsorted(m.frequent, pairs[0]))
            yield as_batch({"shard": pa.array([s for s, _ in blobs], pa.int32()), "blob": pa.array([b for _, b in blobs], pa.binary())})

    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        grams, n = _merged(table.column("blob"))
        if shard < model.shards:
            kind, content = "tries", lmtrie.context_trie(grams, n, universe, held.value.unigram_of, discount)
        else:
            kind, content = ("merged" if shard < spread else "successors"), packed([*grams, n])
        lmtrie.put(f"{path}/{kind}-{shard:06d}", content)
        returned()
        return pa.table({"shard": pa.array([shard], pa.int32()), "tokens": pa.array([int(n.sum())], pa.int64())})

    done = {r["shard"]: r["tokens"] for r in by_arrow(rows, count, "shard int, blob binary").groupBy("shard").applyInArrow(write, "shard int, tokens long").collect()}
    freed(spark)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, merged in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = int(np.searchsorted(begins, shard, "right")) - 1
                *grams, n = unpacked(bytes(lmtrie.opened(f"{path}/merged-{shard:06d}"))) if merged else [np.zeros(0, np.uint64)] * (order + 1)
                _, after, m = unpacked(bytes(lmtrie.opened(f"{path}/successors-{spread + place:06d}")))
                lmtrie.put(f"{path}/tries-{shard:06d}", lmtrie.context_trie(grams, n, universe, held.value.unigram_of, discount, (int(model.frequent[place]), after, m)))
            yield batch

    # Every shard of a frequent word that has successors gets a trie, also one without grams of its own.
    parts = [s for place, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())) if spread + place in done for s in range(a, b)]
    if parts:  # a row for each
        todo = spark.createDataFrame([(s, s in done) for s in parts], "shard int, merged boolean").repartition(min(len(parts), partitions(spark)), "shard")
        by_arrow(todo, finish, "shard int, merged boolean").count()
    model.tries = np.array(sorted([*(s for s in done if s < model.shards), *parts]), np.int64)
    # What is scored is spread over shards as what was learned from; a task is asked for up to twice a shard's share.
    share = 2 * max(1, model.tokens // model.shards)
    model.askers = {s: -(-n // share) for s, n in done.items() if s < spread and n > share}
    if folder is None:
        transient(spark, path)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row; null texts count as empty, rows repeat as they do in docs.

    Rows are told apart by the task, gather and place where they are read.
    """
    spark = docs.sparkSession
    tuned(spark)
    freed(spark)  # what training shuffled
    held = spark.sparkContext.broadcast(model)
    unknown = U(model.words + 1)
    schema = "shard int, part int, task long, gather long, blob binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        known = Known(m, counted=True)
        task = TaskContext.get().partitionId()
        for gather, (doc_ids, hashes, first) in enumerate(_gathered(batches)):
            ids, counts = known.tokens(hashes)
            columns = m.columns(ids, first)
            base = m.unigram(counts)
            total = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731, B023
            lost = columns[0] == unknown  # nothing is known after these
            own = pa.record_batch({"doc_id": doc_ids, "n_tokens": pa.array(np.diff(first)), "n_known": pa.array(total((counts > 0).astype(np.int64))), "base_score": pa.array(total(base)), "score": pa.array(total(np.where(lost, base, 0)))})
            row = np.repeat(np.arange(len(doc_ids)), np.diff(first)).astype(np.uint64)[~lost]
            columns = [c[~lost] for c in columns]
            del hashes, ids, counts, base, lost
            by = _order(columns)
            columns, row = [c[by] for c in columns], row[by]
            shard = m.shard_of(columns[0], columns[1] if m.order > 2 else None)
            by = np.argsort(shard, kind="stable")
            # The rows' own figures travel as a blob beside the requests, to no shard of words.
            blobs = [(-1 - (task + gather) % m.shards, _ipc(own)), *_by_shard([*(c[by] for c in columns), row[by]], shard[by])]
            n = len(blobs)
            part = [(task + gather) % m.askers.get(s, 1) for s, _ in blobs]
            yield as_batch({"shard": pa.array([s for s, _ in blobs], pa.int32()), "part": pa.array(part, pa.int32()), "task": pa.array([task] * n, pa.int64()), "gather": pa.array([gather] * n, pa.int64()), "blob": pa.array([b for _, b in blobs], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard < 0:
            return table
        m: Model = held.value
        path = m.trie(shard)
        trie = lmtrie.ContextTrie(lmtrie.opened(path)) if path else None
        out: list[bytes] = []
        pending: list[list[np.ndarray]] = []
        size, blobs = 0, table.column("blob")
        for i, blob in enumerate(blobs):
            pending.append(unpacked(blob.as_py()))
            size += len(pending[-1][0])
            if size >= ANSWERED or i == len(blobs) - 1:
                # Rows of all these gathers get numbers of their own.
                begins = np.r_[0, np.cumsum([int(p[-1].max()) + 1 for p in pending])]
                rows = np.concatenate([p[-1].astype(np.int64) + b for p, b in zip(pending, begins)])
                columns = [np.concatenate([p[k] for p in pending]) for k in range(m.order)]
                pending, size = [], 0
                by = _order(columns)
                *context, word = (c[by].astype(np.int64) for c in columns)
                value, done = trie.log10(context, word) if trie else (np.zeros(len(word)), np.zeros(len(word), bool))
                value[~done] += m.unigram_of(word[~done])
                sums, seen = np.bincount(rows[by], value, minlength=begins[-1]), np.bincount(rows, minlength=begins[-1])
                for a, b in zip(begins[:-1], begins[1:]):
                    at = np.flatnonzero(seen[a:b])
                    out.append(packed([at, sums[a:b][at].view(np.uint64)]))
        returned()
        return table.set_column(table.column_names.index("blob"), "blob", pa.array(out, pa.binary()))

    def add(table: pa.Table) -> pa.Table:
        """The rows of a gather, and the sums of their parts in the order of shards, so that every run gives the same."""
        table = table.sort_by("shard")
        blobs = table.column("blob").to_pylist()
        own = pa.ipc.open_stream(blobs[0]).read_all()
        score = own.column("score").to_numpy().copy()
        for blob in blobs[1:]:
            at, part = unpacked(blob)
            score[at.astype(np.int64)] += part.view(np.float64)
        return own.set_column(4, "score", pa.array(score))

    answers = by_arrow(_rows(docs, id_col, text_col), ask, schema).groupBy("shard", "part").applyInArrow(answer, schema)
    return answers.groupBy("task", "gather").applyInArrow(add, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def _ipc(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def train_and_score(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): learned from what isn't held out, for all of docs(doc_id, text).

    Without training rows every token is unknown and the vocabulary empty. Null texts are empty ones, whose only token is the
    end; rows without an id are learned from; rows that repeat are counted and scored as often; very long texts are read whole;
    an empty table gives no rows; other columns are not read.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))), **options)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
