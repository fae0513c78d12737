"""A corpus pipeline over the documents table: quality, line dedup, near duplicates, packing.

Each stage reads what its predecessor kept. The first three return the columns
of documents; the last returns the packed pieces, a row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import written
from corvane.llm.jaccard import one_of_each_class
from corvane.llm.linededup import line_dedup
from corvane.llm.packing import packed_documents
from corvane.llm.quality import good_documents, train
from corvane.llm.queries import tokenizer_path

#: Sites that make a line boilerplate here. Two may be a page and its mirror or a quotation; a line on three is no site's own, however few sites there are.
LINE_SITES = 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored as empty ones; rows that repeat are scored alike; a null id is learned from never. Without
    usable labels every document has the same score of 1/2 or the labels' share, and all stay if that reaches the threshold. An empty table stays
    empty; very long texts are scored whole; columns other than documents' are carried.
    """
    return good_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on LINE_SITES or more sites go from the texts but the first; n_chars follows. No document goes.

    Null texts, ids and sites, repeated rows and other columns are treated as line_dedup says; columns n_lines and n_removed of docs stay.
    """
    cleaned = line_dedup(docs, min_sites=LINE_SITES)
    removed = F.col(cleaned.columns[-1]) > 0
    return cleaned.select(*[F.when(removed, F.char_length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, a similarity of 0.8 or more.

    Rows with a null or a repeated id are documents of their own. Documents without words, null and empty texts among them, are like nothing and all
    stay. An empty table stays empty; other columns are carried, whatever their names.
    """
    return one_of_each_class(docs, words=5, num=80, den=100)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048, a row for each piece.

    A null or empty text is one end token; rows that repeat an id, or have none, are documents of their own; other columns are not read. An empty
    table gives no rows; very long texts are cut into whole sequences.
    """
    return packed_documents(docs, tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packing)]

#: SQL can't express the classifier or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
