"""Reports over documents and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Positions of the sorted values that a report has, as shares, and bins of a round that looks for them.
POSITIONS, BINS = {"p25": (1, 4), "p50": (1, 2), "p75": (3, 4), "p90": (9, 10)}, 1000


def by_type(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks of each document type, most first. Chunks are counted by document before they meet the documents."""
    per_doc = chunks.groupBy("document_id").agg(F.count("*").alias("n"))
    return per_doc.join(documents.select("document_id", "doc_type_category"), "document_id").groupBy("doc_type_category").agg(F.sum("n").alias("chunks")).orderBy(F.desc("chunks"), "doc_type_category")


def by_section(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("section_type").agg(F.count("*").alias("chunks")).orderBy(F.desc("chunks"), "section_type")


def importance_summary(chunks: DataFrame, high: float = 0.6) -> DataFrame:
    """One row: chunks, mean importance (3 decimals), how many are high, their floor percentage, policy decisions."""
    n_high = F.count_if(F.col("importance_score") >= high)
    return chunks.agg(
        F.count("*").alias("chunks"),
        F.round(F.avg("importance_score"), 3).alias("mean_importance"),
        n_high.alias("high"),
        F.floor(100 * n_high / F.greatest(F.lit(1), F.count("*"))).alias("high_percent"),
        F.count_if("is_policy_decision").alias("policy_decisions"),
    )


def order_statistics(rows: DataFrame, value_col: str) -> DataFrame:
    """One row of min, p25, p50, p75, p90, max and floor mean: the values at positions n/4, n/2, 3n/4 and 9n/10 of the sorted values.

    Values are counted by distinct value, and the wanted positions are closed in on by rounds of histograms with BINS bins between the
    least and the greatest value that each can still be: no task sorts or holds all values. Null values don't count; without any all columns are null.
    """
    kind = rows.schema[value_col].dataType
    counts = rows.where(F.col(value_col).isNotNull()).groupBy(F.col(value_col).alias("x")).agg(F.count("*").alias("n")).persist()
    try:
        low, high, total, mean = counts.agg(F.min("x"), F.max("x"), F.sum("n"), F.floor(F.sum(F.col("x") * F.col("n")) / F.sum("n"))).first()
        found = {name: (low, high, (total or 0) * p // q) for name, (p, q) in POSITIONS.items()}
        while open_ := {k: v for k, v in found.items() if v[0] != v[1]}:
            found |= _closer(counts, open_)
    finally:
        counts.unpersist()
    values = [low, *[found[k][0] for k in POSITIONS], high]
    schema = T.StructType([*[T.StructField(name, kind) for name in ("min", *POSITIONS, "max")], T.StructField("mean", T.LongType())])
    return rows.sparkSession.createDataFrame([(*values, None if mean is None else int(mean))], schema)


def _closer(counts: DataFrame, wanted: dict[str, tuple]) -> dict[str, tuple]:
    """For each (least, greatest, position among the values between them) the bin that the position is in, as the same triple."""
    inside = []
    for name, (low, high, _) in wanted.items():
        at = F.least(F.floor((F.col("x").cast("double") - float(low)) / ((float(high) - float(low)) / BINS)), F.lit(BINS - 1))
        inside.append(F.when(F.col("x").between(low, high), F.struct(F.lit(name).alias("name"), at.alias("bin"))))
    bins = counts.select("x", "n", F.explode(F.array_compact(F.array(*inside))).alias("i")).groupBy("i.name", "i.bin").agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    out, seen = {}, dict.fromkeys(wanted, 0)
    for r in sorted(bins.collect(), key=lambda r: r["bin"]):  # BINS rows for each position at most
        position = wanted[r["name"]][2]
        if seen[r["name"]] <= position < seen[r["name"]] + r["n"]:
            out[r["name"]] = (r["low"], r["high"], position - seen[r["name"]])
        seen[r["name"]] += r["n"]
    return out


def key_histogram(chunks: DataFrame, map_col: str, most: int = 10) -> DataFrame:
    """In how many chunks each key of a map occurs, the `most` most frequent."""
    return chunks.select(F.explode_outer(F.map_keys(map_col)).alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("chunks")).orderBy(F.desc("chunks"), "name").limit(most)


def document_totals(chunks: DataFrame) -> DataFrame:
    """Per document: chunks, characters, last page and the first chunk's date."""
    return chunks.groupBy("document_id").agg(F.count("*").alias("total_chunks"), F.sum("char_count").alias("char_count"), F.max("page_end").alias("total_pages"), F.min_by("chunk_date", "position_in_doc").alias("document_date"))


def extraction_report(documents: DataFrame) -> DataFrame:
    """One row: documents, chunks, documents without any (failed) and those with warnings. extraction_warnings() names them."""
    return documents.agg(
        F.count("*").alias("documents"),
        F.sum("total_chunks").alias("chunks"),
        F.count_if(F.col("total_chunks") == 0).alias("failed"),
        F.count_if(F.size("extraction_warnings") > 0).alias("with_warnings"),
    )


def extraction_warnings(documents: DataFrame) -> DataFrame:
    """(filename, failed, warning): a row for each warning of each document, and one without for failed documents without any."""
    return documents.where((F.col("total_chunks") == 0) | (F.size("extraction_warnings") > 0)).select("filename", (F.col("total_chunks") == 0).alias("failed"), F.explode_outer("extraction_warnings").alias("warning"))


def token_summary(rows: DataFrame, token_col: str = "n_tokens", limit: int = 2048) -> DataFrame:
    return rows.agg(F.min(token_col).alias("min"), F.floor(F.sum(token_col) / F.greatest(F.lit(1), F.count("*"))).alias("mean"), F.max(token_col).alias("max"), F.count_if(F.col(token_col) > limit).alias("truncated"))


def orphans(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks without a document: what a foreign key would refuse."""
    return chunks.join(documents.select("document_id"), "document_id", "left_anti")
