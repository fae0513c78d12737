"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the whole text by vectorised numpy code. Trees are
grown level by level from histograms of binned statistics on a bounded sample
of labelled rows, then flattened into arrays, which score a batch of documents
by following all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import as_batch, by_arrow, returned, text_slices, tuned
from corvane.llm.textnum import LOWER, WINDOW, U, column_bytes, word_hashes, word_spans

#: Labelled rows to learn from, at most: those with the smallest hashes of their ids.
SAMPLE = 20_000
THRESHOLD = 0.3

_CLASSES = ("lower", "upper", "digit", "space", "newline", "tab", "full stop", "comma", "bang", "question", "quote", "bracket", "markup", "symbol", "dash", "control", "high")


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("symbol"), np.int64)
    for name, found in (("control", range(32)), ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" "), ("newline", b"\n\r"), ("tab", b"\t"), ("full stop", b"."), ("comma", b",;:"), ("bang", b"!"), ("question", b"?"), ("quote", b"'\"`"), ("bracket", b"()[]{}"), ("markup", b"<>/\\=_|"), ("dash", b"-"), ("high", range(128, 256))):
        table[list(found)] = _CLASSES.index(name)
    return table


_CLASS_OF = _class_table()
STATISTICS = (*(f"share of {c}" for c in _CLASSES), "log bytes", "log words", "log lines", "mean word", "longest word", "mean line", "distinct words", "distinct pairs", "distinct lines", "short words", "upper words", "words ending in a symbol", "share of the commonest byte", "byte entropy")


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row."""
    key = np.sort(rows.astype(np.uint64) << U(44) | hashes >> U(20))
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return np.bincount((key[first] >> U(44)).astype(np.int64), minlength=n)


def _byte_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[row, byte]: how often each byte occurs, a window of the text at a time."""
    n = len(offsets) - 1
    out = np.zeros(n * 256, np.int64)
    for a in range(0, len(data), WINDOW):
        part = data[a : a + WINDOW]
        edges = np.clip(offsets - a, 0, len(part))
        out += np.bincount(np.repeat(np.arange(n), np.diff(edges)) * 256 + part, minlength=n * 256)
    return out.reshape(n, 256)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text; null and empty texts give zeros."""
    data, offsets = column_bytes(column)
    n, sizes = len(column), np.diff(offsets)
    counts = _byte_counts(data, offsets)
    classes = np.zeros((n, len(_CLASSES)))
    for c in range(len(_CLASSES)):
        classes[:, c] = counts[:, _CLASS_OF == c].sum(axis=1)
    size = np.maximum(sizes, 1)[:, None]
    share = counts / size
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)

    starts, ends, rows = word_spans(data, offsets)
    length = ends - starts
    words = np.bincount(rows, minlength=n)
    per = np.maximum(words, 1)
    mean = lambda x: np.bincount(rows, x, minlength=n) / per
    longest = np.zeros(n)
    np.maximum.at(longest, rows, length)
    hashes = word_hashes(LOWER[data], starts, ends)
    same = rows[1:] == rows[:-1]
    pairs = (hashes[1:] * U(0x9E3779B97F4A7C15) + hashes[:-1])[same] * U(0xD6E8FEB86659FD93)
    first, last = data[starts], data[ends - 1] if len(ends) else data[:0]
    second = data[np.minimum(starts + 1, ends - 1)] if len(ends) else data[:0]
    upper = (first >= 65) & (first <= 90) & (second >= 65) & (second <= 90)
    symbol = np.isin(_CLASS_OF[last], [_CLASSES.index("symbol"), _CLASSES.index("markup"), _CLASSES.index("bang")])

    # Lines: spans between \n, hashed as the sum of their bytes times powers, by the same code as words.
    cuts = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1][sizes > 0], cuts[cuts + 1 < len(data)] + 1]))
    line_start = np.unique(line_start)
    line_end = np.r_[line_start[1:], len(data)] if len(line_start) else line_start
    line_row = np.searchsorted(offsets[1:], line_start, side="right")
    lines = np.bincount(line_row, minlength=n)
    line_hash = word_hashes(data, line_start, line_end) if len(line_start) else np.zeros(0, np.uint64)

    out = [
        *(classes / size).T,
        np.log1p(sizes),
        np.log1p(words),
        np.log1p(lines),
        mean(length),
        np.minimum(longest, 1000),
        sizes / np.maximum(lines, 1),
        _distinct(rows, hashes, n) / per,
        _distinct(rows[1:][same], pairs, n) / np.maximum(words - 1, 1),
        _distinct(line_row, line_hash, n) / np.maximum(lines, 1),
        mean(length <= 3),
        mean(upper),
        mean(symbol),
        share.max(axis=1),
        entropy,
    ]
    return np.stack(out, axis=1).astype(np.float32)


@dataclass
class FlatTrees:
    """Trees as arrays: node i of tree t asks statistic[t, i] <= border[t, i] and has children 2i + 1 and 2i + 2."""

    statistic: np.ndarray
    border: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        trees = np.arange(len(self.leaf))
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for s in range(0, len(x), 4096):
            part = x[s : s + 4096]
            at = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(depth):
                value = np.take_along_axis(part, self.statistic[trees, at], axis=1)
                at = 2 * at + 1 + (value > self.border[trees, at])
            total[s : s + 4096] += self.leaf[trees, at - self.statistic.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, bins: int = 64, rate: float = 0.1, penalty: float = 1.0, least: int = 10) -> FlatTrees:
    """Boosts trees of logistic loss. Without rows or with one label, the score is constant.

    All nodes of a level share one histogram pass. A node that can't gain sends all rows left.
    """
    n, k = x.shape
    share = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    flat = FlatTrees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1)), base)
    if n < 2 * least or y.min() == y.max():
        return flat
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(borders)], axis=1)  # bin <= i: value <= border i
    slot = binned + np.arange(k) * bins
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            width = 1 << level
            where = (slot + node[:, None] * (k * bins)).ravel()
            shape = (width, k, bins)
            g = np.bincount(where, np.repeat(gradient, k), minlength=width * k * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(where, np.repeat(hessian, k), minlength=width * k * bins).reshape(shape).cumsum(axis=2)
            c = np.bincount(where, minlength=width * k * bins).reshape(shape).cumsum(axis=2)
            gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + penalty) + (gt - g) ** 2 / (ht - h + penalty) - gt**2 / (ht + penalty)
            gain[(c < least) | (ct - c < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            feature, cut = best // bins, best % bins
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            first = width - 1
            for i in np.flatnonzero(good):
                flat.statistic[t, first + i] = feature[i]
                flat.border[t, first + i] = borders[feature[i]][cut[i]]
            right = good[node] & (binned[np.arange(n), feature[node]] > cut[node])
            node = 2 * node + right
        g = np.bincount(node, gradient, minlength=inner + 1)
        h = np.bincount(node, hessian, minlength=inner + 1)
        flat.leaf[t] = -rate * g / (h + penalty)
        margin += flat.leaf[t][node]
    return flat


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id's decimal text leaves no remainder; a null id isn't held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, sample: int = SAMPLE, folds: int = 5, **options) -> FlatTrees:
    """Trees from at most `sample` labelled rows whose id isn't held out; others and null labels are never looked at.

    Repeated ids are learned as often as they occur in docs, at most 16 times `sample` rows in all.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").where(~held_out(F.col("id"), folds))
    known = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("text", "label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            x = statistics(part.column(0))
            yield as_batch({"x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32())), "label": part.column(1)})

    table = by_arrow(rows, measure, "x array<float>, label int").orderBy(F.xxhash64("x"), "x", "label").limit(16 * sample).toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)) if len(table) else np.zeros((0, len(STATISTICS)), np.float32)
    y = table.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((y, *x.T)) if len(y) else []
    return fit(x[order], y[order], **options)


def good_documents(docs: DataFrame, model: FlatTrees, text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they are, whose score is at least threshold; null texts score as empty ones."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, f"c{at}"):
            yield part.filter(pa.array(held.value.score(statistics(part.column(at))) >= threshold))
        returned()

    tuned(docs.sparkSession)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with points can't be mapped
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Null and empty texts have a score, that of statistics that are all zero; very long ones are read whole. A null id isn't held
    out. Rows that repeat are scored alike. Without usable labels, or with those of one kind, all scores are the same.
    An empty table gives no rows; other columns are not read.
    """
    model = train(docs, labels, id_col, text_col, **options)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield as_batch({"doc_id": part.column(0), "score": pa.array(held.value.score(statistics(part.column(1))))})

    out = by_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), score, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
