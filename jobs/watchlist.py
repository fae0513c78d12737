"""Standing searches: a list of saved queries, answered over all documents in one pass.

    python -m jobs.watchlist jobs/watchlist.json [--documents PATH] [--vectors PATH] [--output PATH]

A saved query has words, an example document, or both, and may be limited to languages. Texts and vectors are read once for all
queries; the two rankings of a query are fused by reciprocal ranks, as a search does. The result is

    output/query=NAME/    the query's hits by rank; one row without a document if there are none

written with dynamic partition overwrite: a run replaces the partitions of the queries in its list, and those of
other lists stay. It depends on the tables and the list only, so running it again leaves the same rows.
"""

from __future__ import annotations

import argparse
import json
import logging
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.operators import fuse, many

log = logging.getLogger(__name__)

HITS = "query string, rank int, doc_id long, score double, lexical_rank int, vector_rank int, lang string, source string"


def checked(queries: list[dict]) -> list[dict]:
    """The list, if every query has a name of its own that can be a folder's, and something to look for."""
    names = [q["name"] for q in queries]
    for q in queries:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", q["name"]) or names.count(q["name"]) > 1:
            raise ValueError(f"{q['name']!r} is no name of a query, or one of two")
        if not q.get("words") and q.get("like") is None:
            raise ValueError(f"query {q['name']} has neither words nor an example")
    return queries


def run(spark: SparkSession, documents: str, vectors: str, output: str, *, queries: list[dict], recall: int = fuse.RECALL, hits: int = 10) -> int:
    """Answers the queries and writes their partitions; gives the number of hits.

    documents: Parquet with doc_id, text, lang, source; vectors: Parquet with vec_id, the document's doc_id, and embedding. queries: {"name", "words", "like": a
    doc_id, "langs"}. A null text has no words; a document without a vector or an example that isn't there is found by words only.
    """
    checked(queries)
    docs = spark.read.parquet(documents).select("doc_id", "text", F.coalesce("lang", F.lit("und")).alias("lang"), "source")
    rows = spark.read.parquet(vectors).select(F.col("vec_id").alias("doc_id"), "embedding")
    about = docs.select("doc_id", "lang", "source")
    langs = {q["name"]: q["langs"] for q in queries if q.get("langs")}
    lexical = many.lexical_recall(docs, {q["name"]: q["words"] for q in queries if q.get("words")}, recall, id_col="doc_id", group_col="lang", groups=langs)
    like = [q["like"] for q in queries if q.get("like") is not None]
    examples = {r["doc_id"]: r["embedding"] for r in rows.where(F.col("doc_id").isin(like)).collect()} if like else {}  # as many as queries at most
    asked = {q["name"]: examples[q["like"]] for q in queries if q.get("like") in examples}
    near = many.vector_recall(rows.join(about, "doc_id"), asked, recall, id_col="doc_id", group_col="lang", groups=langs)
    lexical, near = lexical.persist(), near.persist()  # recall rows a query at most, asked for three times
    try:
        fused = fuse.rrf([lexical, near], id_col="doc_id", by=("query",))
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("rrf_score", 9)), "first_list", "first_rank"))
        best = fused.withColumn("rank", place).where(F.col("rank") <= hits)
        for name, ranking in (("lexical_rank", lexical), ("vector_rank", near)):
            best = best.join(ranking.select("query", "doc_id", F.col("rank").alias(name)), ["query", "doc_id"], "left")
        best = about.join(F.broadcast(best), "doc_id")  # hits rows a query; the documents stay where they are
        every = spark.createDataFrame([(q["name"],) for q in queries], "query string").join(best, "query", "left")
        out = every.select("rank", "doc_id", F.round("rrf_score", 9).alias("score"), "lexical_rank", "vector_rank", "lang", "source", "query")
        out.repartition("query").sortWithinPartitions("query", "rank").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query").parquet(output)
    finally:
        lexical.unpersist()
        near.unpersist()
    found = read(spark, output).where(F.col("query").isin([q["name"] for q in queries]) & F.col("doc_id").isNotNull()).count()
    log.info("%d queries over %d documents of %s and the vectors of %s; %d hits written to %s", len(queries), docs.count(), documents, vectors, found, output)
    return found


def read(spark: SparkSession, output: str) -> DataFrame:
    """All hits, as the runs so far have left them."""
    return spark.read.schema(HITS).parquet(output)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Answers saved queries over all documents.")
    parser.add_argument("config")
    for name in ("documents", "vectors", "output"):
        parser.add_argument(f"--{name}")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("watchlist").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        config = json.loads(spark.read.text(args.config, wholetext=True).first()[0])
        documents, vectors, output = (getattr(args, k) or config[k] for k in ("documents", "vectors", "output"))
        run(spark, documents, vectors, output, queries=config["queries"], recall=config.get("recall", fuse.RECALL), hits=config.get("hits", 10))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
