"""Incremental ingestion: new files or rows through the stages, loaded batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvane.functions.taxonomy import DOMAIN, Taxonomy
from corvane.operators import chunking, embed, enrich
from corvane.sources.store import Store, latest


def stages(documents: DataFrame, load: embed.Loader, model: str, taxonomy: Taxonomy = DOMAIN) -> tuple[DataFrame, DataFrame]:
    """documents(document_id, pages, and their description) to (documents, enriched and vectorized chunks)."""
    chunks = chunking.chunk_documents(documents)
    totals = chunks.groupBy("document_id").agg(F.count("*").cast("int").alias("total_chunks"), F.sum("char_count").alias("char_count"))
    rich = enrich.embed_text(enrich.enrich_chunks(chunks, documents, taxonomy), model, taxonomy)
    described = documents.withColumn("total_pages", F.size("pages")).drop("pages").join(totals, "document_id", "left").fillna(0, ["total_chunks", "char_count"])
    return described, embed.with_vectors(rich, load, model).drop("embed_text")


def ingest(source: DataFrame, store: Store, load: embed.Loader, model: str, dimension: int, checkpoint: str, *, taxonomy: Taxonomy = DOMAIN, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Starts a stream of documents(document_id, pages, ...) into the store.

    A batch replaces the documents it brings, so one that runs twice after a failure leaves
    the same tables. Of rows that repeat a document within a batch, store.latest() keeps one. A batch's chunks
    are vectorized once and held until it is loaded.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows = latest(rows).persist()
        documents, chunks = stages(rows, load, model, taxonomy)
        chunks = chunks.persist()
        try:
            store.load(documents, chunks, dimension)
            if then:
                then(rows, number)
        finally:
            chunks.unpersist()
            rows.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def documents_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of documents under a folder, some files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(folder)
