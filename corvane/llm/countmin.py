"""Count-min sketches of the parts of a table, merged by range of cells, and asked without anybody holding a whole one.

A part (a unit of rows) sends what it counted as the sorted cells of each row of the
sketch, one compressed blob for each range of cells. The task of a range adds the blobs of all
parts and answers each with a bit for each of its cells: whether the merged count reaches the limit. A part that
knows its keys again reads its answers in the same order. A merged count is never under the true one, so no key that
reaches the limit is missed; how many others pass depends on the number of cells only, which
the caller sets by what is counted. Blobs and answers grow with what a part counts, never with the sketch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame

from corvane.llm.common import returned
from corvane.llm.textnum import U, mix

#: A seed for each row of a sketch; a key's estimate is the least of its cells.
SEEDS = (U(0x243F6A8885A308D3), U(0x13198A2E03707344))
#: Cells that the task of a range holds, a byte each, at most.
RANGE = 1 << 23
REQUEST = "unit int, line int, shard int, n int, blob binary"
ANSWER = "unit int, line int, shard int, mask binary"


def squeezed(*columns: np.ndarray) -> bytes:
    """Number columns of one length, each by its bytes' places, so that bytes that are mostly alike stand together."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unsqueezed(blob: bytes, n: int, *types: type) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    out, at = [], 0
    for kind in types:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(planes[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def steps(sorted_values: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, the first as it is; np.cumsum turns them back."""
    out = sorted_values.copy()
    out[1:] -= sorted_values[:-1]
    return out


@dataclass(frozen=True)
class Sketch:
    """cells of a row in `shards` ranges; counts stop at `limit`, at most 255, as only reaching it matters."""

    cells: int
    shards: int
    limit: int

    @staticmethod
    def of(cells: int, limit: int, shards: int = 1) -> Sketch:
        """With that many cells or a few more, in at least so many ranges."""
        shards = max(1, shards, -(-cells // RANGE))
        return Sketch(-(-max(cells, 1) // shards) * shards, shards, limit)

    @property
    def span(self) -> int:
        return self.cells // self.shards

    def _places(self, keys: np.ndarray, line: int) -> np.ndarray:
        return mix(keys + SEEDS[line]) % U(self.cells)

    def _cut(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(places, np.arange(self.shards + 1, dtype=np.uint64) * U(self.span))

    def requests(self, unit: int, keys: np.ndarray, counts: np.ndarray | None = None) -> pa.Table:
        """What a unit counted, as REQUEST: its keys may repeat; counts: of each key, 1 if not given."""
        out: dict[str, list] = {c: [] for c in ("unit", "line", "shard", "n", "blob")}
        for line in range(len(SEEDS)):
            places = self._places(keys, line)
            if counts is None:
                places.sort()
                weights = None
            else:
                order = np.argsort(places)
                places, weights = places[order], counts[order]
            first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else np.zeros(0, np.int64)
            many = np.diff(np.r_[first, len(places)]) if weights is None else np.add.reduceat(weights, first) if len(first) else first
            places, many = places[first], np.minimum(many, self.limit).astype(np.uint8)
            at = self._cut(places)
            for shard in np.flatnonzero(at[1:] > at[:-1]).tolist():
                a, b = at[shard], at[shard + 1]
                local = (places[a:b] - U(shard * self.span)).astype(np.uint32)
                for name, value in (("unit", unit), ("line", line), ("shard", shard), ("n", int(b - a)), ("blob", squeezed(steps(local), many[a:b]))):
                    out[name].append(value)
        return pa.table({"unit": pa.array(out["unit"], pa.int32()), "line": pa.array(out["line"], pa.int32()), "shard": pa.array(out["shard"], pa.int32()), "n": pa.array(out["n"], pa.int32()), "blob": pa.array(out["blob"], pa.binary())})

    def answers(self, requests: DataFrame) -> DataFrame:
        """REQUEST rows of all units to ANSWER rows: a task adds a range's blobs, one after another."""
        span, limit = self.span, self.limit

        def merged(table: pa.Table) -> pa.Table:
            cells = np.zeros(span, np.uint8)
            held = list(zip(table.column("blob").to_pylist(), table.column("n").to_pylist()))
            for blob, n in held:
                local, many = unsqueezed(blob, n, np.uint32, np.uint8)
                place = np.cumsum(local, dtype=np.int64)
                cells[place] = np.minimum(cells[place].astype(np.int32) + many, limit)
            masks = [zstandard.ZstdCompressor(level=1).compress(np.packbits(cells[np.cumsum(unsqueezed(blob, n, np.uint32, np.uint8)[0], dtype=np.int64)] >= limit).tobytes()) for blob, n in held]
            out = pa.table({"unit": table.column("unit"), "line": table.column("line"), "shard": table.column("shard"), "mask": pa.array(masks, pa.binary())})
            del cells, held
            returned()
            return out

        return requests.groupBy("line", "shard").applyInArrow(merged, ANSWER)

    def reached(self, keys: np.ndarray, answers: pa.Table) -> np.ndarray:
        """For each key of a unit, whether its estimate reaches the limit, from the unit's answers."""
        out = np.ones(len(keys), bool)
        for line in range(len(SEEDS)):
            own = answers.filter(pa.compute.equal(answers.column("line"), line))
            masks = dict(zip(own.column("shard").to_pylist(), own.column("mask").to_pylist()))
            places = self._places(keys, line)
            different = np.sort(places)
            different = different[np.r_[True, different[1:] != different[:-1]]] if len(different) else different
            at, over = self._cut(different), np.zeros(len(different), bool)
            for shard in np.flatnonzero(at[1:] > at[:-1]).tolist():
                a, b = at[shard], at[shard + 1]
                over[a:b] = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(masks[shard]), np.uint8), count=b - a)
            out &= over[np.searchsorted(different, places)] if len(keys) else out
        return out
