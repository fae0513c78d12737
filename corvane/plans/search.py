"""Hybrid search: parsed filters, two recalls, fusion, relaxation, post-filters, fallback, diversity and boost."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.taxonomy import DOMAIN, Taxonomy
from corvane.operators import filters, fuse, recall
from corvane.operators.filters import AdvancedFilters
from corvane.operators.index import CellIndex
from corvane.plans.parse import parse_query
from corvane.plans.profiles import FULL, Profile
from corvane.sources.indexes import Indexes, Snapshot
from corvane.sources.store import Store


def joined(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with their documents' columns; Spark broadcasts documents when they are small enough by its own measure."""
    extra = [c for c in ("filename", "doc_type_category", "institution", "document_date", "document_year") if c in documents.columns]
    return chunks.drop(*[c for c in extra if c in chunks.columns]).join(documents.select("document_id", *extra), "document_id")


def stored_dimension(chunks: DataFrame) -> int | None:
    """The one dimension of the stored vectors; None if there are none, an error if there are several."""
    low, high = chunks.agg(F.min(F.size("embedding")), F.max(F.when(F.col("embedding").isNotNull(), F.size("embedding")))).first()
    if high is not None and chunks.where((F.size("embedding") != high) & F.col("embedding").isNotNull()).limit(1).count():
        raise ValueError(f"stored vectors have dimensions from {low} to {high}")
    return high


def reconciled(vector: Sequence[float], dimension: int | None) -> list[float]:
    """A query vector cut or padded with zeros to the stored dimension."""
    if dimension is None:
        return list(vector)
    return (list(vector) + [0.0] * dimension)[:dimension]


def _recalled(rows: DataFrame, where: Column, vector: Sequence[float], words: str, n: int, cells: DataFrame | None = None, own: Snapshot | None = None) -> DataFrame:
    """Both recalls fused and held. cells: rows that the vector recall is limited to; own: the indexes that both recalls go through."""
    some = rows.where(where)
    if own is None:
        close = some if cells is None else some.join(cells.select("chunk_id"), "chunk_id", "left_semi")
        return _held(fuse.fuse(recall.vector_recall(close, vector, n), recall.lexical_recall(some, words, n)))
    ids = some.select("chunk_id")
    near, lexical = own.near(ids, vector, n).collect(), own.lexical(ids, words, n).collect()  # n rows each
    spark, found = rows.sparkSession, sorted({r["chunk_id"] for r in [*near, *lexical]})
    held = _held(some.where(F.col("chunk_id").isin(found)))
    of = lambda hits, name: held.join(F.broadcast(spark.createDataFrame([tuple(r) for r in hits], f"chunk_id string, {name} double")), "chunk_id")
    return _held(fuse.fuse(of(near, "vector_score"), of(lexical, "lexical_score")))


def _held(hits: DataFrame) -> DataFrame:
    """At most 2 n rows as a local table: later steps look at them more than once, and nothing stays cached."""
    return hits.sparkSession.createDataFrame(hits.collect(), hits.schema)


def search(chunks: DataFrame, documents: DataFrame, query: str, embed: Callable[[str], Sequence[float]], k: int = 5, *, use_mmr: bool = True, taxonomy: Taxonomy = DOMAIN, n: int = fuse.RECALL, profile: Profile = FULL, index: CellIndex | None = None, own: Snapshot | None = None, dimension: int | None = None) -> tuple[DataFrame, dict]:
    """The k best chunks and the parsed query. dimension: of the stored vectors, looked up if not given.

    index: cells of a table that doesn't change, of which the vector recall looks at those near the query; what it gives are the rows of chunks. own: indexes
    of the version of a store that chunks are of, see search_store().

    Nothing found with variables or sections asked for: both are dropped and
    recall runs again. Month and exact date filter what was recalled, never the
    recall. Still nothing: the most important chunks under the unrelaxed filters.
    """
    parsed = parse_query(query, taxonomy, profile)
    rows = joined(chunks, documents)
    vector, stored = list(embed(parsed["clean_query"])), stored_dimension(chunks) if dimension is None else dimension
    if stored is not None and stored != len(vector) and not profile.reconcile:
        raise ValueError(f"the query's vector has {len(vector)} dimensions, stored ones have {stored}")
    vector = reconciled(vector, stored)
    cells = index.cells(vector) if index else None
    hits = _recalled(rows, filters.search_filter(parsed), vector, parsed["clean_query"], n, cells, own)
    if (parsed["variables"] or parsed["sections"]) and hits.isEmpty():
        hits = _recalled(rows, filters.search_filter(parsed | {"variables": [], "sections": []}), vector, parsed["clean_query"], n, cells, own)
    after = _after(parsed)
    hits = hits.where(after)
    if profile.fallback and hits.isEmpty():
        found = recall.importance_recall(rows.where(filters.search_filter(parsed)), max(4 * k, 20)).where(after)
        hits = _held(found.withColumn("rrf_score", F.lit(0.0)).withColumn("order", F.row_number().over(fuse.Window.partitionBy(F.lit(0)).orderBy(F.desc("importance_score"), "page_start", "chunk_id"))))
    if use_mmr:
        hits = hits.join(fuse.mmr(hits, vector, 2 * k), "chunk_id")
    return fuse.importance_boost(hits, k), parsed


def search_store(store: Store, indexes: Indexes, query: str, embed: Callable[[str], Sequence[float]], k: int = 5, **options) -> tuple[DataFrame, dict]:
    """search() on one version of a store through its indexes: recall reads postings and cells, and of the tables only what filters name, until the hits are known.

    Buckets that were loaded after the last refresh are scanned, so hits are those of the tables as they stand. The
    vector recall is approximate in indexed buckets, the lexical one is exact.
    """
    version = store.version()
    return search(store.frame(version, "chunks"), store.frame(version, "documents"), query, embed, k, own=indexes.at(version), dimension=version["dimension"], **options)


def _after(parsed: dict) -> Column:
    out = F.lit(True)
    if parsed.get("month") is not None:
        out &= F.coalesce(filters.effective_month() == parsed["month"], F.lit(False))
    if parsed.get("exact_date") is not None:
        out &= filters.matches_exact_date(parsed["exact_date"])
    return out


def advanced_search(chunks: DataFrame, documents: DataFrame, own: AdvancedFilters, query: str | None = None, k: int = 10, *, embed: Callable[[str], Sequence[float]] | None = None, n: int = fuse.RECALL) -> DataFrame:
    """The k best chunks under explicit filters: hybrid with an embedder, full-text without one, by importance without a query."""
    rows = joined(chunks, documents).where(own.predicate())
    if not query:
        return recall.importance_recall(rows, n).where(own.after_recall()).orderBy(F.desc("importance_score"), "page_start", "chunk_id").limit(k)
    if embed is None:
        return recall.lexical_recall(rows, query, n).where(own.after_recall()).orderBy(F.desc("lexical_score"), "chunk_id").limit(k)
    hits = fuse.fuse(recall.vector_recall(rows, embed(query), n), recall.lexical_recall(rows, query, n)).where(own.after_recall())
    return fuse.importance_boost(hits, k)
