"""An approximate index for vector recall: rows in cells around centroids, of which a query looks at the nearest.

Centroids are fitted to a bounded sample by k-means; every row is put in its cell, and the table is
written by cell, so that a query reads only the cells it looks at. How many it
looks at is measured: the fewest with which sampled rows find the wanted share of their true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from corvane.operators import many, recall

#: Rows that centroids are fitted to, at most; sampled queries; and rows that a cell should hold.
SAMPLE, QUERIES, CELL_ROWS = 20_000, 64, 4000
#: The fewest and the most cells.
CELLS = (16, 4096)


def _units(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def centroids(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """k-means on unit vectors, from the first rows in a fixed shuffle; an empty cell keeps its centroid."""
    x = _units(x)
    out = x[np.random.default_rng(5).permutation(len(x))[:cells]]
    for _ in range(rounds):
        own = (x @ out.T).argmax(axis=1)
        total = np.zeros_like(out)
        np.add.at(total, own, x)
        out = np.where(np.bincount(own, minlength=len(out))[:, None] > 0, _units(total), out)
    return out


@dataclass
class CellIndex:
    """The written rows, their centroids and the number of cells that a query looks at."""

    rows: DataFrame
    centroids: np.ndarray
    probes: int
    vector_col: str

    def cells(self, query: Sequence[float], probes: int | None = None) -> DataFrame:
        """The rows of the cells nearest to a query."""
        q = _units(np.asarray([query], float))[0]
        order = np.argsort(-(self.centroids @ q), kind="stable")[: probes or self.probes]
        return self.rows.where(F.col("cell").isin(*map(int, order))).drop("cell")

    def near_many(self, queries: DataFrame, n: int = 50, *, id_col: str = "chunk_id") -> DataFrame:
        """(query, id, vector_score, rank): near() of each row (query, x) of a table, its own id left out, as many.nearest() has them.

        Rows are dealt out by ranges of cells, large ranges in several blocks of bounded size; a query goes to the blocks of the cells that it looks at.
        """
        dimension, probes, middles = self.centroids.shape[1], self.probes, self.rows.sparkSession.sparkContext.broadcast(self.centroids)
        rows = self.rows.where(F.col(id_col).isNotNull())
        sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # a row for each cell, at most CELLS[1]
        range_of, blocks, size = {}, [], 0  # the range of each cell; the first block of each range and how many it has
        for cell in sorted(sizes):
            if not size or (size + sizes[cell]) * dimension > many.ROWS_BLOCK:
                blocks.append([sum(blocks[-1]) if blocks else 0, 1])
                size = 0
            size += sizes[cell]
            blocks[-1][1] = many.parts_of(size, dimension, many.ROWS_BLOCK)
            range_of[cell] = len(blocks) - 1
        table = self.rows.sparkSession.createDataFrame([(c, *blocks[k]) for c, k in range_of.items()], "cell int, first int, parts int")
        dealt = rows.join(F.broadcast(table), "cell").select(F.col(id_col).alias("id"), F.col(self.vector_col).alias("v"), "cell", (F.col("first") + F.pmod(F.xxhash64(id_col), "parts")).cast("int").alias("block"))

        def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.nan_to_num(b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension))
                cells = np.argsort(-(_units(x) @ middles.value.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
                to = [sorted({k for c in own if int(c) in range_of for k in range(blocks[range_of[int(c)]][0], sum(blocks[range_of[int(c)]]))}) for own in cells]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(cells), pa.list_(pa.int32())), pa.array(to, pa.list_(pa.int32()))], names=[*b.schema.names, "cells", "blocks"])

        asked = queries.where((F.size("x") == dimension) & F.col("query").isNotNull()).select("query", "x")
        asked = asked.mapInArrow(looked, StructType([*asked.schema.fields, StructField("cells", ArrayType(IntegerType())), StructField("blocks", ArrayType(IntegerType()))]))
        return many.met(dealt, asked, n, dimension).withColumnRenamed("id", id_col)

    def near(self, query: Sequence[float], n: int = 50, *, id_col: str = "chunk_id", probes: int | None = None) -> DataFrame:
        """The n rows of the greatest cosine similarity in those cells, as vector_recall() has them."""
        return recall.vector_recall(self.cells(query, probes), query, n, id_col=id_col, vector_col=self.vector_col)


def sampled(rows: DataFrame, dimension: int, most: int, vector_col: str = "embedding", id_col: str = "chunk_id") -> np.ndarray:
    """Vectors of `most` rows at most, chosen by a hash of the identifier; of none, one zero vector."""
    seen = rows.select(F.col(vector_col).cast("array<double>").alias("v"), F.xxhash64(id_col).alias("h")).orderBy("h").limit(most).toArrow()
    x = seen.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension) if len(seen) else np.zeros((1, dimension))
    return np.nan_to_num(x)


def fitted(rows: DataFrame, dimension: int, count: int, *, vector_col: str = "embedding", id_col: str = "chunk_id", sample: int = SAMPLE) -> np.ndarray:
    """Centroids for so many rows, from a bounded sample of them."""
    x = sampled(rows, dimension, sample, vector_col, id_col)
    return centroids(x, min(CELLS[1], max(CELLS[0], count // CELL_ROWS), len(x)))


def assigned(rows: DataFrame, middles: np.ndarray, dimension: int, vector_col: str = "embedding") -> DataFrame:
    """rows and the cell of each, the nearest centroid's."""
    held = rows.sparkSession.sparkContext.broadcast(middles)  # at most 4,096 vectors
    at = rows.columns.index(vector_col)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((np.nan_to_num(v) @ held.value.T).argmax(axis=1).astype(np.int32) if b.num_rows else [], pa.int32())], names=[*b.schema.names, "cell"])

    return rows.mapInArrow(assign, StructType([*rows.schema.fields, StructField("cell", IntegerType())]))


def build(chunks: DataFrame, folder: str, *, vector_col: str = "embedding", id_col: str = "chunk_id", wanted: float = 0.95, n: int = 20, sample: int = SAMPLE) -> CellIndex:
    """An index of all rows that have a vector of the most frequent dimension, written under folder; for a table that doesn't change.

    Null and empty vectors and those of another dimension are left out, as exact recall leaves them out; rows that repeat an id are rows of
    their own. Without rows the index finds nothing. sources.indexes keeps one for a store, which loads change.
    """
    spark: SparkSession = chunks.sparkSession
    sizes = chunks.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dimension, count = (sizes[0]["d"], sizes[0]["count"]) if sizes else (1, 0)
    rows = chunks.where(F.size(vector_col) == dimension)
    middles = fitted(rows, dimension, count, vector_col=vector_col, id_col=id_col, sample=sample)
    held = assigned(rows, middles, dimension, vector_col)
    # Ranges of (cell, row), so that a cell of equal vectors is several tasks.
    held.repartitionByRange("cell", F.xxhash64(id_col)).write.partitionBy("cell").mode("overwrite").parquet(folder)
    index = CellIndex(spark.read.schema(held.schema).parquet(folder), middles, len(middles), vector_col)
    index.probes = measured(index, sampled(rows, dimension, QUERIES, vector_col, id_col), n, wanted)
    return index


def measured(index: CellIndex, sample: np.ndarray, n: int, wanted: float) -> int:
    """The fewest cells with which sampled queries find the wanted share of their neighbours, the neighbours found by looking at all rows."""
    q = _units(np.nan_to_num(sample[:QUERIES]))
    queries = index.rows.sparkSession.sparkContext.broadcast(q)
    at, dimension = index.rows.columns.index(index.vector_col), q.shape[1]
    cell_at = index.rows.columns.index("cell")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, own = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int32)  # a task's n best of each query
        for b in batches:
            if not b.num_rows:
                continue
            v = _units(np.nan_to_num(b.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)))
            score = np.concatenate([top, queries.value @ v.T], axis=1)
            cell = np.concatenate([own, np.broadcast_to(b.column(cell_at).to_numpy().astype(np.int32), (len(q), b.num_rows))], axis=1)
            best = np.argsort(-score, axis=1, kind="stable")[:, :n]
            top, own = np.take_along_axis(score, best, 1), np.take_along_axis(cell, best, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q)), top.shape[1]).astype(np.int32)), pa.array(top.ravel()), pa.array(own.ravel())], names=["q", "score", "cell"])

    found = index.rows.mapInArrow(look, "q int, score double, cell int")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cell"))).where(F.col("r") <= n)
    place = np.argsort(np.argsort(-(q @ index.centroids.T), axis=1, kind="stable"), axis=1)  # rank of each cell for each query
    ranks = np.array([place[r["q"], r["cell"]] for r in best.select("q", "cell").collect()])  # n rows of each sampled query
    if not len(ranks):
        return 1
    return int(np.sort(ranks)[min(len(ranks) - 1, int(np.ceil(wanted * len(ranks))) - 1)]) + 1
