"""Recall for many queries at once: texts and vectors are read once for all of them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from corvane.functions.text import lexemes
from corvane.operators import recall

#: Queries of one pass; more are answered in several.
BLOCK = 500
#: Components of the vectors of a block of rows and of a part of a table of queries, which meet in one task; queries of one product in it.
ROWS_BLOCK, QUERIES_PART, STEP = 1 << 21, 1 << 18, 128
#: Decimals that scores are compared to, so that rankings don't depend on the order of sums.
DIGITS = {"vector_score": 12, "lexical_score": 6}


def _best(rows: DataFrame, score: str, n: int, id_col: str) -> DataFrame:
    """rank (from 1) and the n best rows of each query, ties by id; each task keeps n of its own before any meet (n < 1000)."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round(score, DIGITS[score])), id_col))
    return rows.withColumn("rank", rank).where(F.col("rank") <= n)


def _blocks(names: list[str]) -> Iterator[list[str]]:
    for a in range(0, len(names), BLOCK):
        yield names[a : a + BLOCK]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vector_recall(rows: DataFrame, queries: Mapping[str, Sequence[float]], n: int = 50, *, id_col: str = "chunk_id", vector_col: str = "embedding", group_col: str | None = None, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(query, id, vector_score, rank): for each query the n rows of the greatest cosine similarity, ties by id, as recall.vector_recall() has them.

    Each batch of rows is one matrix product with a block of queries, of which every task keeps n rows a query. Null, empty and zero vectors and those of
    another length than a query's take no part in it; neither does a query without length. groups: values of group_col that a query is limited to.
    """
    if not queries:
        return rows.select(F.lit("").alias("query"), id_col, F.lit(0.0).alias("vector_score"), F.lit(0).alias("rank")).where("false")
    held = rows.where(F.size(vector_col) > 0).select(id_col, F.col(vector_col).cast("array<double>").alias("v"), *([F.col(group_col).cast("string").alias("own_group")] if group_col else []))
    schema = StructType([StructField("q", IntegerType()), rows.schema[id_col], StructField("vector_score", DoubleType())])
    parts = []
    for names in _blocks(list(queries)):
        found = held.mapInArrow(_product([np.asarray(queries[x], float) for x in names], [None if not groups or groups.get(x) is None else set(groups[x]) for x in names], n, id_col), schema)
        parts.append(found.withColumn("query", F.element_at(F.array(*map(F.lit, names)), F.col("q") + 1)).select("query", id_col, "vector_score"))
    return _best(_union(parts), "vector_score", n, id_col)


def _product(vectors: list[np.ndarray], limits: list[set[str] | None], n: int, id_col: str):  # noqa: ANN202
    """A mapping of batches (id, v, own_group) to each query's n best rows of a task; ties at the end of the n are all kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = sorted({len(x) for x in vectors})
        of = {d: [i for i, x in enumerate(vectors) if len(x) == d and np.linalg.norm(x) > 0] for d in sizes}
        units = {d: np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in own]).reshape(len(own), d) for d, own in of.items()}
        best: dict[int, tuple[np.ndarray, pa.Array]] = {}
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            v = b.column(1)
            lengths = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
            group = np.array(b.column(2).to_pylist(), object) if b.num_columns > 2 else None
            for d in sizes:
                at = np.flatnonzero(lengths == d)
                if not len(at) or not of[d]:
                    continue
                x = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), d)
                with np.errstate(all="ignore"):
                    scores = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ units[d].T
                fine = np.isfinite(scores[:, 0])
                for k, q in enumerate(of[d]):
                    some = fine if limits[q] is None or group is None else fine & np.isin(group[at], list(limits[q]))
                    score, ids = scores[some, k], b.column(0).take(pa.array(at[some]))
                    if q in best:
                        score, ids = np.concatenate([best[q][0], score]), pa.concat_arrays([best[q][1], ids])
                    if len(score) > n:
                        digits = np.round(score, DIGITS["vector_score"])
                        keep = np.flatnonzero(digits >= np.partition(digits, len(digits) - n)[len(digits) - n])
                        if len(keep) > 4 * n:  # many ties: the smallest ids of them
                            order = np.lexsort((pa.compute.rank(ids.take(pa.array(keep)), null_placement="at_start").to_numpy(), -digits[keep]))
                            keep = keep[order[:n]]
                        score, ids = score[keep], ids.take(pa.array(keep))
                    best[q] = score, ids
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(best), np.int32), [len(s) for s, _ in best.values()])), pa.concat_arrays([i.cast(kind) for _, i in best.values()]), pa.array(np.concatenate([s for s, _ in best.values()]))], names=["q", id_col, "vector_score"])

    return run


def parts_of(rows: int, dimension: int, most: int) -> int:
    """How many blocks of `most` components at most so many vectors make."""
    return max(1, -(-rows * dimension // most))


def nearest(rows: DataFrame, queries: DataFrame, n: int, dimension: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, id, vector_score, rank): for each row (query, x) of a table the n rows of the greatest cosine similarity, its own id left out, found by looking at all rows.

    Both tables are dealt out in blocks of bounded size, and each two blocks are one task's matrix products, so neither is held whole
    anywhere. Vectors that aren't of the dimension, are zero or hold null or non-finite components, and rows without id take no part.
    """
    rows, queries = rows.where((F.size(vector_col) == dimension) & F.col(id_col).isNotNull()), queries.where((F.size("x") == dimension) & F.col("query").isNotNull())
    count = parts_of(rows.count(), dimension, ROWS_BLOCK)
    dealt = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.lit(0).alias("cell"), F.pmod(F.xxhash64(id_col), F.lit(count)).cast("int").alias("block"))
    asked = queries.select("query", "x", F.lit(None).cast("array<int>").alias("cells"), F.sequence(F.lit(0), F.lit(count - 1)).alias("blocks"))
    return met(dealt, asked, n, dimension).withColumnRenamed("id", id_col)


def met(rows: DataFrame, queries: DataFrame, n: int, dimension: int) -> DataFrame:
    """(query, id, vector_score, rank) of rows (id, v, cell, block) and queries (query, x, cells, blocks): a query meets the rows of its blocks, of these only those in its cells, if they aren't null."""
    parts = parts_of(queries.count(), dimension, QUERIES_PART)
    left = queries.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int")).withColumn("block", F.explode("blocks")).drop("blocks")
    right = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = StructType([queries.schema["query"], rows.schema["id"], StructField("vector_score", DoubleType())])

    def products(asked: pa.Table, held: pa.Table) -> pa.Table:
        q, r = _whole(asked, "x", "query", dimension), _whole(held, "v", "id", dimension)
        ids, own = r.column("id").to_numpy(), q.column("query").to_numpy()
        v, x = _matrix(r, "v", dimension), _matrix(q, "x", dimension)
        cell = r.column("cell").to_numpy()
        cells, at, score = q.column("cells").to_pylist(), [], []
        width = max([int(cell.max(initial=0)), *(max(c, default=0) for c in cells if c is not None)]) + 1
        first, after = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for a in range(0, len(x) if len(v) else 0, STEP):
            s = x[a : a + STEP] @ v.T
            looked = np.ones((len(s), width), bool)
            for i in range(len(s)):
                s[i, first[a + i] : after[a + i]] = -np.inf
                if cells[a + i] is not None:
                    looked[i] = False
                    looked[i, cells[a + i]] = True
            if not looked.all():
                s[~looked[:, cell]] = -np.inf
            least = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n] - 1e-11 if s.shape[1] > n else np.full(len(s), -2.0)
            i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
            digits = np.round(s[i, j], DIGITS["vector_score"])
            order = np.lexsort((j, -digits, i))  # rows stand in order of their ids, so ties keep the smallest
            i, j = i[order], j[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i, "left") < n
            at.append(np.stack([i[keep] + a, j[keep]]))
            score.append(s[i[keep], j[keep]])
        i, j = np.concatenate(at, axis=1) if at else np.zeros((2, 0), np.int64)
        return pa.table({"query": q.column("query").take(pa.array(i)), "id": r.column("id").take(pa.array(j)), "vector_score": pa.array(np.concatenate(score) if score else [], pa.float64())})

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(products, schema)
    return _best(found, "vector_score", n, "id")


def _matrix(rows: pa.Table, vector_col: str, dimension: int) -> np.ndarray:
    """The vectors scaled to length 1; null components are NaN."""
    v = rows.column(vector_col).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimension)
    with np.errstate(all="ignore"):
        return v / np.linalg.norm(v, axis=1, keepdims=True)


def _whole(rows: pa.Table, vector_col: str, by: str, dimension: int) -> pa.Table:
    """The rows whose vector has a direction, in order of `by`."""
    rows = rows.filter(pa.array(np.isfinite(_matrix(rows, vector_col, dimension)).all(axis=1)))
    return rows.sort_by(by)


def lexical_recall(texts: DataFrame, queries: Mapping[str, str], n: int = 50, *, id_col: str = "chunk_id", text_col: str = "text", group_col: str | None = None, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(query, id, lexical_score, rank): for each query the n texts with all its lexemes of the greatest cover density, ties by id.

    Each text is split once; only places of some query's lexemes are kept, and a row is made for each query that a text answers. Nothing is
    shuffled before each task has its n best of each query. A query without lexemes finds nothing. groups: values of group_col that a query is limited to.
    """
    terms = {x: recall.query_lexemes(q) for x, q in queries.items()}
    asked = [x for x in queries if terms[x]]
    if not asked:
        return texts.select(F.lit("").alias("query"), id_col, F.lit(0.0).alias("lexical_score"), F.lit(0).alias("rank")).where("false")
    parts = []
    for names in _blocks(asked):
        every = F.array(*[F.lit(t) for t in sorted({t for x in names for t in terms[x]})])
        found = F.filter(F.transform(lexemes(F.col(text_col)), lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda h: F.array_contains(every, h["word"]))
        rows = texts.select(id_col, *([F.col(group_col).cast("string").alias("own_group")] if group_col else []), found.alias("found"))
        rows = rows.withColumn("have", F.array_distinct(F.transform("found", lambda h: h["word"])))
        own = F.array(*[F.struct(F.lit(x).alias("query"), F.array(*map(F.lit, terms[x])).alias("terms"), _limits(groups, x).alias("limits")) for x in names])
        answers = F.filter(own, lambda q: (F.size(F.array_except(q["terms"], F.col("have"))) == 0) & (q["limits"].isNull() | F.array_contains(q["limits"], F.col("own_group")) if group_col else F.lit(True)))
        rows = rows.select(id_col, "found", F.explode(answers).alias("q"))
        places = F.transform(F.filter("found", lambda h: F.array_contains(F.col("q.terms"), h["word"])), lambda h: F.struct(h["at"].alias("at"), F.array_position(F.col("q.terms"), h["word"]).cast("int").alias("term")))
        rows = rows.select("q.query", id_col, F.size("q.terms").alias("n_terms"), places.alias("places"))
        parts.append(rows.select("query", id_col, recall.density(F.col("places"), F.col("n_terms")).alias("lexical_score")))
    return _best(_union(parts), "lexical_score", n, id_col)


def _limits(groups: Mapping[str, Sequence[str]] | None, name: str) -> Column:
    own = groups.get(name) if groups else None
    return F.lit(None).cast("array<string>") if own is None else F.array(*map(F.lit, own)).cast("array<string>")
