"""Incremental chunking: documents that arrive as new Parquet files become enriched chunks.

    python -m jobs.chunk_stream jobs/chunk_stream.json [--source PATH] [--output PATH] [--checkpoint PATH]

A file stream with availableNow takes the files that its checkpoint doesn't know, cuts their documents into overlapping
chunks, enriches these with a taxonomy, and writes each batch to folders of its own:

    output/chunks/batch=N/lang=L/    a row for each chunk
    output/documents/batch=N/        a row for each document, written last: a batch without it isn't there for readers

A batch that is run again after a failure has the same number and the same files, so it overwrites its own folders with
the same rows. current() gives the collection as it stands: of a document that was delivered again, the last delivery.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.taxonomy import Taxonomy
from corvane.operators import chunking, enrich

log = logging.getLogger(__name__)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CHUNKS = "doc_id long, chunk_id string, position int, text string, char_count int, section_type string, importance_score double, tags array<string>, variables array<string>, batch int, lang string"
WRITTEN = "doc_id long, lang string, source string, n_chunks long, char_count long, batch int"
#: What a delivery of a document is ordered by: the file's time, its path, the row's place.
_DELIVERY = ("file_modification_time", "file_path", "row_index")


def run(spark: SparkSession, source: str, output: str, checkpoint: str, *, taxonomy: Taxonomy, chunks: dict | None = None, numbers: tuple = T.NUMERIC, files_per_batch: int = 10_000) -> int:
    """Takes all files under source that are new, in batches, and gives the number of batches; waits until they are done.

    source: a Parquet file, folder or pattern with DOCUMENTS' columns; others are not read. chunks: options of chunk_documents(). Rows
    without doc_id are counted in the log and left out; a null or empty text makes a document without chunks; a null lang is `und`.
    """
    batches = []

    def write(batch: DataFrame, number: int) -> None:
        batches.append(_written(spark, batch, number, output, taxonomy, chunks or {}, numbers))

    files = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", files_per_batch).parquet(_pattern(source))
    rows = files.select("doc_id", "text", F.coalesce("lang", F.lit("und")).alias("lang"), "source", F.struct(*[F.col(f"_metadata.{c}") for c in _DELIVERY]).alias("delivery"))
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("%d batches read from %s, written to %s", len(batches), source, output)
    return len(batches)


def _pattern(path: str) -> str:
    """The path as a pattern that only it fits: a stream takes a pattern of files and folders alike, but as a plain path folders only."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[]{}") else f"{path[:-1]}[{path[-1]}]"


def _written(spark: SparkSession, batch: DataFrame, number: int, output: str, taxonomy: Taxonomy, options: dict, numbers: tuple) -> int:
    """Writes one batch; gives the number of its documents."""
    again = batch.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("delivery").alias("last")).where("n > 1").select(F.col("doc_id").alias("again_id"), "last")
    last = batch.where("doc_id is not null").join(again, F.col("doc_id") == F.col("again_id"), "left").where("last is null or last = delivery")
    made = enriched_chunks(last, taxonomy, options, numbers)
    made.write.mode("overwrite").partitionBy("lang").parquet(f"{output}/chunks/batch={number}")
    counted = spark.read.schema(made.schema).parquet(f"{output}/chunks/batch={number}").groupBy(F.col("doc_id").alias("own_id")).agg(F.count("*").alias("n_chunks"), F.sum("char_count").alias("char_count"))
    documents = last.select("doc_id", "lang", "source").join(counted, F.col("doc_id") == F.col("own_id"), "left").select("doc_id", "lang", "source", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), F.coalesce("char_count", F.lit(0)).alias("char_count"))
    documents.write.mode("overwrite").parquet(f"{output}/documents/batch={number}")
    read, nameless = batch.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    n, total = spark.read.parquet(f"{output}/documents/batch={number}").agg(F.count("*"), F.sum("n_chunks")).first()
    log.info("batch %d: %d rows read, %d of them without doc_id; %d documents and %d chunks written to %s", number, read, nameless, n, total or 0, output)
    return n


def enriched_chunks(documents: DataFrame, taxonomy: Taxonomy, options: dict, numbers: tuple = T.NUMERIC) -> DataFrame:
    """(doc_id, lang, chunk_id, position, text, char_count, section_type, importance_score, tags, variables), a row for each chunk.

    The document's other columns travel inside its identifier, so chunks need no join to get them back.
    """
    own = F.struct("doc_id", "lang").alias("document")
    cut = chunking.chunk_documents(documents.select(own, F.array("text").alias("pages")), "document", **options)
    rows = cut.select("document_id.*", "position_in_doc", "total_in_doc", "section_title_raw", "text", "char_count", T.normalize_text(F.col("text")).alias("normal"))
    rows = rows.withColumn("counts", enrich.keyword_counts(F.col("normal"), taxonomy))
    normal, own = F.col("normal"), F.col("counts")
    rows = rows.withColumns({"variables": enrich.variables(normal, taxonomy, own), "entities": enrich.entities(normal, taxonomy, own), "numbers": T.numeric_values(F.col("text"), numbers), "forward": enrich.forward(normal, taxonomy, own)})
    rows = rows.withColumn("section_type", enrich.section(normal, F.col("position_in_doc"), F.col("total_in_doc"), F.col("section_title_raw"), taxonomy, own)["type"])
    score: Column = enrich.importance(normal, F.col("variables"), F.col("numbers"), F.col("section_type"), F.col("entities"), F.col("forward"), taxonomy, counts=own)
    tags: Column = enrich.tags(normal, F.col("variables"), F.col("numbers"), F.col("section_type"), taxonomy, own)
    return rows.select(
        "doc_id",
        F.format_string("%d_%04d", "doc_id", "position_in_doc").alias("chunk_id"),
        F.col("position_in_doc").alias("position"),
        "text",
        "char_count",
        "section_type",
        score.alias("importance_score"),
        tags.alias("tags"),
        F.map_keys("variables").alias("variables"),
        "lang",
    )


def current(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, documents) as they stand after one run or more: each document's last batch. A batch whose documents aren't written isn't read."""
    documents = spark.read.schema(WRITTEN).parquet(f"{output}/documents")
    last = documents.groupBy("doc_id").agg(F.max("batch").alias("batch"))
    chunks = spark.read.schema(CHUNKS).parquet(f"{output}/chunks")
    return chunks.join(last, ["doc_id", "batch"]), documents.join(last, ["doc_id", "batch"])


def taxonomy_of(config: dict) -> Taxonomy:
    """The configuration's taxonomy: {"variables": {name: [level, [words]]}, "sections": {name: [words]}, "entities", "forward", "boilerplate"}."""
    fields = dict(config)
    fields["variables"] = {name: (level, words) for name, (level, words) in fields.get("variables", {}).items()}
    return Taxonomy(**fields)


def numbers_of(config: list | None) -> tuple:
    """[[pattern, unit]] of the configuration, or the library's own."""
    return tuple(map(tuple, config)) if config else T.NUMERIC


def config_at(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="New documents become enriched chunks.")
    parser.add_argument("config")
    for name in ("source", "output", "checkpoint"):
        parser.add_argument(f"--{name}")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("chunk_stream").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        config = config_at(spark, args.config)
        source, output, checkpoint = (getattr(args, k) or config[k] for k in ("source", "output", "checkpoint"))
        run(spark, source, output, checkpoint, taxonomy=taxonomy_of(config["taxonomy"]), chunks=config.get("chunks"), numbers=numbers_of(config.get("numbers")), files_per_batch=config.get("files_per_batch", 10_000))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
