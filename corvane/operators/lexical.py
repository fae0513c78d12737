"""An inverted index for lexical recall: postings with positions, sorted by term, from which rankings come without any text.

A row for each term and text, made where the text lies and sorted by (part, term, identifier) within each task, so a query's terms are a few row groups of
each file by Parquet's statistics, and the list of a frequent term lies in several files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from corvane.functions.text import lexemes
from corvane.operators import recall

#: What one occurrence can add to a score.
MOST = 0.1
#: Tokens that are sorted at once, unless one text has more.
TOKENS = 1 << 20


def postings(texts: DataFrame, *, id_col: str = "chunk_id", text_col: str = "text", part_cols: tuple[str, ...] = (), files: int | None = None) -> DataFrame:
    """(part_cols, term, id, n, at): how often and where each lexeme occurs in each text, sorted within each task, or in `files` ranges.

    Rows that repeat an id count as one text, as a union of their places; null and empty texts have no rows. Nothing is shuffled but the
    identifiers, to see whether some repeat, and, if so, one row for each term and text.
    """
    keys = [*part_cols, "term", "id"]
    texts = texts.select(*part_cols, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    repeated = not texts.groupBy(*part_cols, "id").count().where("count > 1").isEmpty()
    own = texts.select(*part_cols, "id", lexemes(F.col("text")).alias("words"))
    schema = StructType([*own.schema.fields[:-1], StructField("term", StringType()), StructField("n", IntegerType()), StructField("at", ArrayType(IntegerType()))])
    listed = own.mapInArrow(_listed, schema)
    if repeated:
        listed = listed.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at")).withColumn("n", F.size("at"))
    if files:
        listed = listed.repartitionByRange(files, *keys)
    return listed.select(*keys, "n", "at").sortWithinPartitions(*keys)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of texts given as words: for each term of each the number of its places, and these in order."""
    for b in batches:
        ends = np.cumsum(pa.compute.list_value_length(b.column("words")).fill_null(0).to_numpy())
        a = 0
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TOKENS, "right")))
            yield _places(b.slice(a, z - a))
            a = z


def _places(b: pa.RecordBatch) -> pa.RecordBatch:
    sizes = pa.compute.list_value_length(b.column("words")).fill_null(0).to_numpy().astype(np.int64)
    words = b.column("words").flatten().dictionary_encode()
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = row * max(1, len(words.dictionary)) + words.indices.to_numpy().astype(np.int64)
    order = np.argsort(key, kind="stable")  # places stay in order
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    first, offsets = order[starts], np.append(starts, len(row)).astype(np.int32)
    at = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[order].astype(np.int32)))
    term = words.dictionary.take(words.indices.take(pa.array(first)))
    own = [b.column(c).take(pa.array(row[first])) for c in range(b.num_columns - 1)]
    return pa.RecordBatch.from_arrays([*own, term, pa.array(np.diff(offsets)), at], names=[*b.schema.names[:-1], "term", "n", "at"])


def top(index: DataFrame, terms: list[str], n: int, allowed: DataFrame | None = None) -> DataFrame:
    """(id, lexical_score): the n texts with all terms of the greatest cover density, ties by id; the rows that lexical_recall() finds.

    allowed: (id) that the search is limited to. The rarest term's texts come first, the others are limited to them. A text whose terms occur h times
    has h - terms + 1 covers at most and scores no more than MOST for each: the n of the greatest bounds are
    scored, and then only those whose bound reaches the n-th of these scores.
    """
    if not terms:
        return index.sparkSession.createDataFrame([], "id string, lexical_score double").select(F.col("id").cast(index.schema["id"].dataType), "lexical_score")
    rows = index.where(F.col("term").isin(terms))
    frequency = {r["term"]: r["texts"] for r in rows.groupBy("term").agg(F.count("*").alias("texts")).collect()}  # a row for each term of the query
    if len(frequency) < len(terms):
        return rows.where("false").select("id", F.lit(0.0).alias("lexical_score"))
    rare = rows.where(F.col("term") == min(terms, key=lambda t: (frequency[t], t))).select("id")
    if allowed is not None:
        rare = rare.join(allowed, "id", "left_semi")
    both = rows.join(rare, "id", "left_semi") if len(terms) > 1 or allowed is not None else rows
    bounds = both.groupBy("id").agg(F.sum("n").alias("hits"), F.count("*").alias("terms")).where(F.col("terms") == len(terms)).select("id", (MOST * (F.col("hits") - len(terms) + 1)).alias("bound"))

    def scored(some: DataFrame) -> DataFrame:
        where = F.array(*map(F.lit, terms))
        own = rows.join(some.select("id"), "id", "left_semi").select("id", F.transform("at", lambda x: F.struct(x.alias("at"), F.array_position(where, F.col("term")).cast("int").alias("term"))).alias("places"))
        every = own.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
        return every.select("id", recall.density(F.col("places"), len(terms)).alias("lexical_score"))

    best = scored(bounds.orderBy(F.desc("bound"), "id").limit(n)).agg(F.min("lexical_score").alias("least"), F.count("*").alias("n")).first()
    if best["n"] == n:  # sums of covers round; a bound a little lower may still be reached
        bounds = bounds.where(F.col("bound") >= best["least"] * (1 - 1e-9))
    return scored(bounds).orderBy(F.desc("lexical_score"), "id").limit(n)
