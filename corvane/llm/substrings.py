"""Substring dedup: words covered by a window of words that occurs earlier go.

Units of texts count their windows in count-min sketches, which merge by range of cells and overestimate only. A
second pass groups exactly, by 128 bits of hash, the windows whose estimate is two or more, each unit's
different ones once; since units are ranges of the texts in order, the smallest unit that has a window has its first
occurrence. A third pass reads its unit's answers and takes the covered words out. Nothing is dropped or
capped: a window that occurs in every text sends one entry for each unit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from corvane.llm.common import freed, partitions, returned, tuned, written
from corvane.llm.countmin import ANSWER, REQUEST, Sketch, squeezed, steps, unsqueezed
from corvane.llm.textnum import U, column_bytes, joined_words, mix, word_hashes, word_spans
from corvane.llm.units import in_units, sorted_by_place

#: Words of a window.
WIDTH = 20
#: Cells of a row of the sketch for each window, text bytes that are taken to hold a window, and windows for each shard of the exact pass. They change cost only.
CELLS, WORD_BYTES, SHARD = 4, 6, 1 << 20
#: Answers of the exact pass have this line.
EXACT = -1
#: A second hash of a word is the first one over other bytes.
_OTHER = np.roll(np.arange(256, dtype=np.uint8), 97)


class Words:
    """The words of a unit's texts, and which of them start a window."""

    def __init__(self, texts: pa.Array, width: int):
        self.data, offsets = column_bytes(texts)
        self.starts, self.ends, rows = word_spans(self.data, offsets)
        self.first = np.searchsorted(rows, np.arange(len(texts) + 1))
        self.width = width
        n = len(rows) - width + 1
        self.windows = np.flatnonzero(rows[:n] == rows[width - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def _rolled(self, hashes: np.ndarray, base: U) -> np.ndarray:
        n = len(hashes) - self.width + 1
        out = np.zeros(max(n, 0), np.uint64)
        for k in range(self.width if n > 0 else 0):
            out *= base
            out += hashes[k : k + n]
        return mix(out)[self.windows]

    def keys(self) -> np.ndarray:
        """64 bits of hash of each window."""
        return self._rolled(word_hashes(self.data, self.starts, self.ends), U(0x9E3779B97F4A7C15))

    def others(self) -> np.ndarray:
        """64 further bits."""
        return self._rolled(word_hashes(_OTHER[self.data], self.starts, self.ends), U(0xC2B2AE3D27D4EB4F))

    def without(self, gone: np.ndarray) -> pa.Array:
        """Each text's words that aren't gone, joined by one space."""
        kept = np.flatnonzero(~gone)
        return joined_words(self.data, self.starts, self.ends, kept, np.searchsorted(kept, self.first))


def _different(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of windows by both hashes, earlier ones first, and which of it is the first of its kind."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, first


def _cut(k1: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of ascending hashes begins; shards are even ranges of hashes."""
    at = np.searchsorted(k1, np.array([-((-s << 64) // shards) for s in range(shards)], np.uint64))
    return np.r_[at, len(k1)]


def first_units(requests: DataFrame) -> DataFrame:
    """Windows that units sent, by shard; answers each unit with a bit for each: whether no smaller unit has it."""

    def grouped(table: pa.Table) -> pa.Table:
        parts = [unsqueezed(blob, n, np.uint64, np.uint64) for blob, n in zip(table.column("blob").to_pylist(), table.column("n").to_pylist())]
        sizes, units = np.array([len(a) for a, _ in parts]), np.array(table.column("unit"))
        k1, k2 = np.concatenate([np.cumsum(a, dtype=np.uint64) for a, _ in parts]), np.concatenate([b for _, b in parts])
        order = np.lexsort((np.repeat(units, sizes), k2, k1))
        a, b = k1[order], k2[order]
        first = np.empty(len(order), bool)
        first[order] = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        masks = [zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes()) for x in np.split(first, np.cumsum(sizes)[:-1])]
        out = pa.table({"unit": table.column("unit"), "line": pa.array([EXACT] * len(units), pa.int32()), "shard": table.column("shard"), "mask": pa.array(masks, pa.binary())})
        del parts, k1, k2, order, a, b, first
        returned()
        return out

    return requests.groupBy("shard").applyInArrow(grouped, ANSWER)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, n_words long, n_removed long), a row for each row of docs: its words less those covered by repeated windows.

    Words are runs of other characters than \\x20 and \\x09-\\x0D, unchanged, and are joined by one space. A window is
    `width` consecutive words of one text; every word covered by a window whose words also start earlier goes: in
    a row with a smaller id (null before all), or earlier in the same text, overlaps included. Windows are judged on the texts as given.
    Rows that repeat an id come one after another in the order of their texts' hashes; of equal rows, one is the first. A
    null text has no words and stays null; an empty text, one of white space and one with nothing left are empty. Fewer than
    `width` words have no window and stay. Long texts are read whole; a text's words take some 100 bytes each in
    its task. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tuned(spark)
    kind = docs.schema[id_col].dataType
    columns = [F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    units, size = in_units(docs, columns, [F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))], "substrings")
    freed(spark)
    sketch = Sketch.of(CELLS * (size // WORD_BYTES), 2, partitions(spark))
    shards = max(partitions(spark), size // WORD_BYTES // SHARD)

    def counted(key: tuple, table: pa.Table) -> pa.Table:
        out = sketch.requests(key[0].as_py(), Words(sorted_by_place(table).column("text").combine_chunks(), width).keys())
        returned()
        return out

    def suspected(words: Words, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose estimate is two or more, and both their hashes."""
        keys = words.keys()
        held = np.flatnonzero(sketch.reached(keys, answers))
        k1 = keys[held]
        return words.windows[held], k1, words.others()[held]

    def asked(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"shard": [], "n": [], "blob": []}
        if table.num_rows:
            _, k1, k2 = suspected(Words(sorted_by_place(table).column("text").combine_chunks(), width), answers)
            order, first = _different(k1, k2)
            k1, k2 = k1[order[first]], k2[order[first]]
            at = _cut(k1, shards)
            for shard in np.flatnonzero(at[1:] > at[:-1]).tolist():
                a, b = at[shard], at[shard + 1]
                for name, value in (("shard", shard), ("n", int(b - a)), ("blob", squeezed(steps(k1[a:b]), k2[a:b]))):
                    out[name].append(value)
        rows = len(out["n"])
        returned()
        return pa.table({"unit": pa.array([key[0].as_py()] * rows, pa.int32()), "line": pa.array([EXACT] * rows, pa.int32()), "shard": pa.array(out["shard"], pa.int32()), "n": pa.array(out["n"], pa.int32()), "blob": pa.array(out["blob"], pa.binary())})

    def cleaned(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        table = sorted_by_place(table)
        texts = table.column("text").combine_chunks()
        words = Words(texts, width)
        windows, k1, k2 = suspected(words, answers.filter(pa.compute.greater_equal(answers.column("line"), 0)))
        order, first = _different(k1, k2)
        exact = answers.filter(pa.compute.equal(answers.column("line"), EXACT)).sort_by("shard")
        at = _cut(k1[order[first]], shards)
        sizes = (at[1:] - at[:-1])[at[1:] > at[:-1]]
        masks = [np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(m), np.uint8), count=n) for m, n in zip(exact.column("mask").to_pylist(), sizes.tolist(), strict=True)]
        stays = np.zeros(len(order), bool)  # the first of all occurrences
        stays[order[first]] = np.concatenate(masks).astype(bool) if masks else []
        repeated = windows[~stays]
        edges = np.zeros(len(words.starts) + 1, np.int32)
        edges[repeated] += 1
        edges[repeated + width] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        total = np.r_[0, np.cumsum(gone)]
        text = words.without(gone)
        text = pa.compute.if_else(texts.is_valid(), text, pa.scalar(None, pa.large_string())) if texts.null_count else text
        out = pa.table({"doc_id": table.column("doc_id"), "text": text.cast(pa.string()), "n_words": pa.array(np.diff(words.first)), "n_removed": pa.array(np.diff(total[words.first]).astype(np.int64))})
        del words, windows, k1, k2, order, first
        returned()
        return out

    estimates = written(sketch.answers(units.select("unit", "place", "text").groupBy("unit").applyInArrow(counted, REQUEST)), "estimates")
    freed(spark)
    per_unit = units.select("unit", "place", "text").groupBy("unit").cogroup(estimates.groupBy("unit"))
    exact = written(first_units(per_unit.applyInArrow(asked, REQUEST)), "firsts")
    freed(spark)
    schema = StructType([StructField("doc_id", kind), *StructType.fromDDL("text string, n_words long, n_removed long").fields])
    return units.groupBy("unit").cogroup(estimates.unionByName(exact).groupBy("unit")).applyInArrow(cleaned, schema)
