"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Each tree writes a vector as a string of bits; a bit is the sign of the vector's product with a random direction. Rows are
dealt out in blocks. A block keeps each tree as a sorted array of its rows' strings. A query descends in each tree to the
longest prefix that it shares with another row and ascends in all trees at once, one bit a step, until enough
rows of the block share its prefix in some tree; in the last step it ascends tree by tree and stops where
they are enough, so the number looked at follows what is asked for closely. These are ranked by their
exact inner product, and the best of all blocks are merged.

How many rows are enough is measured: for a bounded sample of queries the true
neighbours are found by brute force, and the smallest share of a ladder that
reaches the wanted recall is taken; beyond the ladder it is all rows.

A vector is shuffled once, to deal it out; queries are read from a written
table, so nothing that grows with the input is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from corvane.llm.common import as_batch, by_arrow, partitions, written
from corvane.llm.lmtrie import store_of

#: Trees, and bits of a string.
TREES, BITS, SEED = 40, 48, 7
#: Bits by which a block's rows are all told apart, beyond the logarithm of their number: deeper prefixes are shared by copies.
DEEP = 4
#: Sampled queries and the recall they must reach.
SAMPLE, RECALL = 64, 0.95
#: Rows that share a query's prefix, summed over the trees, as a share of a block: values to try.
LADDER = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 1.0, 1.15, 1.3, 1.45, 1.6, 1.8, 2.0, 2.5, 3.0, 4.0, 5.0, 7.0, 10.0)
#: Bytes of a block's vectors, in double precision, and queries that are searched together.
BLOCK_BYTES, QUERIES = 16 << 20, 512


@lru_cache(2)
def directions(dimension: int, trees: int = TREES) -> np.ndarray:
    """[tree, dimension, bit]: random directions, orthonormal as far as the dimension allows, the same wherever they are made."""
    random = np.random.default_rng(SEED)
    out = np.empty((trees, dimension, BITS), np.float32)
    for tree in out:
        for a in range(0, BITS, dimension):
            tree[:, a : a + dimension] = np.linalg.qr(random.standard_normal((dimension, dimension)))[0][:, : BITS - a]
    return out


def strings(x: np.ndarray, trees: int = TREES) -> np.ndarray:
    """[row, tree]: the strings as numbers, the first bit on top; numbers sort as the strings do."""
    out = np.zeros((len(x), trees), np.int64)
    x = (x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)).astype(np.float32)
    place = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for t, turn in enumerate(directions(x.shape[1], trees)):
        out[:, t] = (x @ turn > 0) @ place
    return out


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first bits two strings share."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows give equal products, wherever they stand."""
    return (x * q).sum(axis=1)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to the smaller id."""
    if len(ids) > 4 * k:
        border = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= border)
        return at[np.lexsort((ids[at], -score[at]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Forest:
    """The trees of a block of rows, as sorted arrays."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, texts: np.ndarray):
        self.rows, self.ids, self.x = rows, ids, x
        self.norm = float(np.sqrt((x * x).sum(axis=1)).max(initial=0))
        self.order = np.argsort(texts, axis=0, kind="stable").T.astype(np.int32)
        self.texts = np.take_along_axis(texts, self.order.T, axis=0).T.copy()
        self.seen = np.zeros(len(rows), bool)

    def longest(self, paths: np.ndarray) -> np.ndarray:
        """[query]: the length of the longest prefix that a row shares in any tree: in a sorted array it is a neighbour's."""
        out = np.zeros(len(paths), np.int64)
        for t, text in enumerate(self.texts):
            at = np.searchsorted(text, paths[:, t])
            for near in (at - 1, at):
                out = np.maximum(out, np.where((near >= 0) & (near < len(text)), shared(text[np.clip(near, 0, len(text) - 1)], paths[:, t]), 0))
        return out

    def ranges(self, paths: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """[query, tree]: where the rows that share `level` bits with each path [query, tree] begin and end."""
        shift = BITS - level
        low = (paths >> shift) << shift
        high = low + (np.int64(1) << shift)
        a, b = (np.stack([np.searchsorted(text, border[:, t]) for t, text in enumerate(self.texts)], axis=1) for border in (low, high))
        return a, b

    def stops(self, paths: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The level at which each query stops, 0 being the root, the last tree that has ascended to it, and the ranges of all trees."""
        level, last = np.zeros(len(paths), np.int64), np.zeros(len(paths), np.int64)
        begin, end = np.zeros(paths.shape, np.int64), np.zeros(paths.shape, np.int64)
        if not np.isfinite(share) or not len(self.rows) or not len(paths):
            return level, last, begin, end
        deepest = np.minimum(self.longest(paths), min(BITS, len(self.rows).bit_length() + DEEP))
        open_, wanted = np.arange(len(paths)), share * len(self.rows)
        before = begin.copy(), end.copy()
        for d in range(int(deepest.max()), 0, -1):
            a, b = self.ranges(paths[open_], d)
            none = deepest[open_] < d
            a[none], b[none] = 0, 0
            inner = before[1] - before[0]
            after = np.cumsum(b - a - inner, axis=1) + inner.sum(axis=1, keepdims=True)  # rows once this tree and those before it have ascended
            stop = after[:, -1] >= wanted
            tree = np.where(deepest[open_[stop]] == d, paths.shape[1] - 1, (after[stop] >= wanted).argmax(axis=1))  # where the descent ended, all trees are
            ascended = np.arange(paths.shape[1]) <= tree[:, None]
            at = open_[stop]
            level[at], last[at] = d, tree
            begin[at], end[at] = np.where(ascended, a[stop], before[0][stop]), np.where(ascended, b[stop], before[1][stop])
            open_, before = open_[~stop], (a[~stop], b[~stop])
            if not len(open_):
                break
        return level, last, begin, end

    def candidates(self, own: np.ndarray, paths: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, bool]]:
        """For each query the rows that its ascent finds, own row left out, and whether it went to the root, where all are."""
        for i, (level, _, a, b) in enumerate(zip(*self.stops(paths, share))):
            if level:
                self.seen[:] = False
                self.seen[np.concatenate([order[x:y] for order, x, y in zip(self.order, a.tolist(), b.tolist())])] = True
                yield np.flatnonzero(self.seen & (self.rows != own[i])), False
            else:
                yield np.flatnonzero(self.rows != own[i]), True

    def nearest(self, own: np.ndarray, vectors: np.ndarray, paths: np.ndarray, share: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(position of the query, ids, scores) of the k best that its ascent finds."""
        for i, (at, _) in enumerate(self.candidates(own, paths, share)):
            at = self.close(at, vectors[i], k)
            score = scores(self.x[at], vectors[i])
            best = _best(self.ids[at], score, k)
            yield i, self.ids[at][best], score[best]

    def close(self, at: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """The rows of `at` that can be among the k best, by products that may be off in their last digits."""
        if len(at) <= 4 * k:
            return at
        rough = self.x[at] @ q
        margin = 1e-10 * self.norm * float(np.sqrt((q * q).sum()))
        if not np.isfinite(margin) or not np.isfinite(rough).all():
            return at
        return at[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - margin]


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[Forest]:
    """Forests of BLOCK_BYTES of vectors."""
    most = max(1024, BLOCK_BYTES // (8 * dimension))
    held: list[pa.RecordBatch] = []

    def made() -> Forest:
        table = pa.Table.from_batches(held).combine_chunks()
        return Forest(table.column(0).to_numpy(), table.column(1).to_numpy(), _matrix(table.column(2).combine_chunks(), dimension), _texts(table.column(3).combine_chunks()))

    for batch in batches:
        while batch.num_rows:
            room = most - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) >= most:
                yield made()
                held = []
    if held:
        yield made()


def _texts(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1) if len(column) else np.zeros((0, TREES), np.int64)


def _asked(uri: str) -> Iterator[pa.RecordBatch]:
    """The rows of a written table of the index, QUERIES at a time."""
    store, path = store_of(uri)
    for info in sorted(store.get_file_info(pa.fs.FileSelector(path)), key=lambda f: f.path):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as source:
                yield from pa.parquet.ParquetFile(source).iter_batches(QUERIES, columns=["row", "id", "v", "s"])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<float> or array<double>) of the rows that can take part: an id, and a vector without null or non-finite components, not zero."""
    v = F.col("v")
    kind = "float" if isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else "double"
    fine = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v")).where(fine)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, every: int = 20, k: int = 20, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k nearest other rows found.

    Vectors that usable() leaves out take no part; those of another dimension
    than the most frequent one are left out as well. Rows that repeat an id are rows of their
    own, as candidates and as queries; only the query's own row is no candidate of it. Fewer than k others give fewer rows,
    an empty table none. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dimension = common[0]["d"] if common else 1
    rows = rows.where(F.size("v") == dimension).select(F.monotonically_increasing_id().alias("row"), "id", "v")
    kind = rows.schema["v"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = strings(_matrix(batch.column(2), dimension), trees).astype("<i8")
                yield as_batch({"row": batch.column(0), "id": batch.column(1), "v": batch.column(2), "s": pa.array([t.tobytes() for t in s], pa.binary())})

    index = written(by_arrow(rows, write, f"row long, id long, v {kind}, s binary").repartition(partitions(spark), "row"), "forest")
    asked = written(index.where(F.col("id") % every == 0), "asked")
    share = _measured(index, asked, dimension, k, recall)
    path = asked.corvane_path

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest in _blocks(batches, dimension):
            for queries in _asked(path):
                own, ids = queries.column(0).to_numpy(), queries.column(1).to_numpy()
                found = list(forest.nearest(own, _matrix(queries.column(2), dimension), _texts(queries.column(3)), share, k))
                of = np.repeat([i for i, _, _ in found], [len(x) for _, x, _ in found]).astype(np.int64)
                yield as_batch({"query": pa.array(own[of]), "query_id": pa.array(ids[of]), "vec_id": pa.array(np.concatenate([x for _, x, _ in found])), "score": pa.array(np.concatenate([s for _, _, s in found]))})

    found = by_arrow(index, search, "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _measured(index: DataFrame, asked: DataFrame, dimension: int, k: int, wanted: float) -> float:
    """The smallest share of LADDER with which the sampled queries reach the wanted recall, else infinity: all rows."""
    sample = asked.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    if not sample:
        return LADDER[0]
    own, vectors = np.array([r["row"] for r in sample]), np.array([r["v"] for r in sample], np.float64)
    paths = np.stack([np.frombuffer(r["s"], "<i8") for r in sample])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest in _blocks(batches, dimension):
            stops = [forest.stops(paths, share)[:2] for share in LADDER]  # what they find grows with the share
            texts = np.empty_like(forest.texts)
            np.put_along_axis(texts, forest.order.astype(np.int64), forest.texts, axis=1)
            tree = np.arange(len(texts))[:, None]
            for q in range(len(own)):
                at = np.flatnonzero(forest.rows != own[q])
                at = forest.close(at, vectors[q], k)
                score = scores(forest.x[at], vectors[q])
                best = _best(forest.ids[at], score, k)
                same = shared(texts[:, at[best]], paths[q][:, None])
                found = np.array([(same >= level[q] + (tree > last[q])).any(axis=0) | (level[q] == 0) for level, last in stops])
                least = (~found).sum(axis=0)  # place in LADDER of the first share that finds it
                yield as_batch({"q": pa.array(np.full(len(best), q, np.int32)), "id": pa.array(forest.ids[at][best]), "score": pa.array(score[best]), "least": pa.array(least.astype(np.int32))})

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    seen = by_arrow(index, look, "q int, id long, score double, least int")
    least = [r["least"] for r in seen.withColumn("rank", rank).where(F.col("rank") <= k).select("least").collect()]  # SAMPLE * k rows
    for i, share in enumerate(LADDER):
        if least and sum(x <= i for x in least) >= wanted * len(least):
            return share
    return float("inf")
