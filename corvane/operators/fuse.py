"""Fusing and re-ranking recalled rows: reciprocal ranks, marginal relevance, importance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import vectors as V

# The parameters of retrieval.
RECALL, RRF_K, MMR_LAMBDA, BOOST, LOW_CONFIDENCE = 50, 60, 0.65, 0.15, 0.05


def ranked(recall: DataFrame, score_col: str, rank_col: str = "rank", *, id_col: str = "chunk_id", by: Sequence[str] = ()) -> DataFrame:
    """Ranks from 1, ties by id; `by` ranks within queries. A recall without `by` has at most its limit of rows."""
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return recall.withColumn(rank_col, F.row_number().over(window.orderBy(F.desc(score_col), id_col)))


def rrf(rankings: Sequence[DataFrame], k: int = RRF_K, *, id_col: str = "chunk_id", by: Sequence[str] = ()) -> DataFrame:
    """(by, id, rrf_score, first_list, first_rank) of rankings with a `rank`: the sum of 1 / (k + rank); one shuffle for any number of lists.

    first_list and first_rank tell the order in which ties stay.
    """
    rows = None
    for i, r in enumerate(rankings):
        own = r.select(*by, id_col, F.lit(i).alias("list"), "rank")
        rows = own if rows is None else rows.unionByName(own)
    score = F.aggregate(F.sort_array(F.collect_list(F.struct("list", "rank"))), F.lit(0.0), lambda a, x: a + 1.0 / (k + x["rank"]))
    return rows.groupBy(*by, id_col).agg(score.alias("rrf_score"), F.min(F.struct("list", "rank")).alias("first")).select(*by, id_col, "rrf_score", F.col("first.list").alias("first_list"), F.col("first.rank").alias("first_rank"))


def fuse(vector_hits: DataFrame, lexical_hits: DataFrame, k: int = RRF_K, *, id_col: str = "chunk_id") -> DataFrame:
    """Both recalls' rows once each, the vector row's columns where both have it, with rrf_score and order."""
    v, x = ranked(vector_hits, "vector_score", id_col=id_col), ranked(lexical_hits, "lexical_score", id_col=id_col)
    scores = rrf([v, x], k, id_col=id_col)
    shared = [c for c in vector_hits.columns if c in lexical_hits.columns]
    rows = v.select(*shared).unionByName(x.select(*shared).join(v.select(id_col), id_col, "left_anti"))
    return rows.join(scores, id_col).withColumn("order", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("rrf_score"), "first_list", "first_rank")))


def mmr(candidates: DataFrame, query: Sequence[float] | None, k: int, weight: float = MMR_LAMBDA, *, by: Sequence[str] = (), id_col: str = "chunk_id", vector_col: str = "embedding", order_col: str = "order", query_col: str | None = None) -> DataFrame:
    """(by, id, mmr_rank): greedy choice of the greatest weight * similarity to the query - (1 - weight) * the greatest to a chosen one.

    Ties go to the earlier row by order_col. A group is one query's recalls, a few
    hundred rows at most, so it is one Arrow batch; queries are spread over tasks.
    """
    rows = candidates.select(*(by or [F.lit(0).alias("query")]), F.col(id_col).alias("id"), F.col(order_col).alias("order"), F.col(vector_col).cast("array<double>").alias("v"), *([F.col(query_col).cast("array<double>").alias("q")] if query_col else []))
    keys = list(by) or ["query"]
    fixed = None if query is None else np.asarray(query, float)
    kinds = dict(rows.dtypes)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "id"])
        vectors = np.stack(group["v"].to_numpy())
        near = vectors @ (fixed if fixed is not None else np.asarray(group["q"].iloc[0], float))
        closest = np.full(len(group), -np.inf)
        left, out = np.ones(len(group), bool), []
        while len(out) < min(k, len(group)):
            value = near if not out else weight * near - (1 - weight) * closest
            best = int(np.argmax(np.where(left, value, -np.inf)))
            out.append(best)
            left[best] = False
            closest = np.maximum(closest, vectors @ vectors[best])
        return group.iloc[out][[*keys, "id"]].assign(mmr_rank=range(1, len(out) + 1))

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), f"id {kinds['id']}", "mmr_rank int"])
    out = rows.groupBy(*keys).applyInPandas(choose, schema).withColumnRenamed("id", id_col)
    return out if by else out.drop("query")


def boosted(weight: float = BOOST) -> Column:
    return F.coalesce("rrf_score", F.lit(0.0)) + F.lit(weight) * F.coalesce(F.col("importance_score").cast("double"), F.lit(0.0))


def importance_boost(hits: DataFrame, k: int, weight: float = BOOST, *, id_col: str = "chunk_id") -> DataFrame:
    """The k rows of the greatest final_score, ties by id, with low_confidence."""
    return hits.withColumn("final_score", boosted(weight)).withColumn("low_confidence", F.col("final_score") < LOW_CONFIDENCE).orderBy(F.desc("final_score"), id_col).limit(k)


def similarity(vector_col: str, query: Sequence[float]) -> Column:
    return V.dot(F.col(vector_col), V.literal(query))
