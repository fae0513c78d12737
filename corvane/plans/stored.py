"""Queries over stores and indexes: loads that run at once, postings, and indexes that follow loads; and SQL that recomputes them."""

from __future__ import annotations

import io
import zipfile
from concurrent.futures import ThreadPoolExecutor
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import filters, lexical, many, recall, stats
from corvane.plans.catalog import _WORDS, _query, _read
from corvane.plans.more import _folder
from corvane.sources import files, store
from corvane.sources.indexes import Indexes
from corvane.sources.reports import Reports

_COVERS = """
h AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w) WHERE word IN ({a}, {b})),
l AS (SELECT doc_id, pos, max(CASE WHEN word = {a} THEN pos END) OVER o AS f, max(CASE WHEN word = {b} THEN pos END) OVER o AS g FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
c AS (SELECT doc_id, least(f, g) AS low, min(pos) AS high FROM l WHERE f IS NOT NULL AND g IS NOT NULL GROUP BY doc_id, least(f, g)),
n AS (SELECT c.doc_id, c.low, c.high, count(*) AS hits FROM c JOIN h ON h.doc_id = c.doc_id AND h.pos BETWEEN c.low AND c.high GROUP BY ALL),
s AS (SELECT doc_id, round(sum(0.1::DOUBLE / (1 + high - low + 1 - hits)), 6) AS score FROM n GROUP BY doc_id)"""


@_query(f"{_WORDS}, {_COVERS.format(a="'the'", b="'and'")} SELECT doc_id, score FROM s ORDER BY score DESC, doc_id LIMIT 50")
def indexed_lexical_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 texts of the greatest cover density, from postings that are written once. Scores are rounded before ties go by id, so more are asked for."""
    folder = f"{_folder(spark)}/postings"
    lexical.postings(_read(spark, sf_dir, "documents"), id_col="doc_id").write.parquet(folder)
    found = lexical.top(spark.read.parquet(folder), recall.query_lexemes("The and"), 200)
    return found.select(F.col("id").alias("doc_id"), F.round("lexical_score", 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(50)


@_query(r"SELECT word AS term, count(*) AS texts, sum(n)::BIGINT AS places, max(last) AS last FROM (SELECT doc_id, word, count(*) AS n, max(pos)::INTEGER - 1 AS last FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM documents)) GROUP BY doc_id, word) GROUP BY word")
def postings_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each lexeme: texts, occurrences and its last place, from the postings."""
    index = lexical.postings(_read(spark, sf_dir, "documents"), id_col="doc_id")
    return index.groupBy("term").agg(F.count("*").alias("texts"), F.sum("n").alias("places"), F.max(F.array_max("at")).alias("last"))


@_query("SELECT doc_id::VARCHAR AS document_id, source AS filename, (doc_id % 4 < 2)::INTEGER AS n_chunks FROM documents")
def concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads at once into the same buckets: none is lost."""
    folder = _folder(spark)
    store.Store(spark, folder, buckets=4).setup()
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("filename"), F.lit("2024-05-06").alias("document_date"), "text", "doc_id")

    def load(k: int) -> int:
        own = docs.where(F.pmod("doc_id", F.lit(4)) == k)
        chunks = own.where(F.lit(k < 2)).select(F.concat("document_id", F.lit("_0000")).alias("chunk_id"), "document_id", "text", F.array(F.lit(1.0), F.lit(float(k))).alias("embedding"))
        return store.Store(spark, folder).load(own, chunks, 2)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, range(4)))
    read = store.Store(spark, folder)
    return read.read("documents").join(read.read("chunks").groupBy("document_id").agg(F.count("*").alias("n")), "document_id", "left").select("document_id", "filename", F.coalesce("n", F.lit(0)).cast("int").alias("n_chunks"))


@_query(rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(CASE WHEN doc_id % 3 = 0 THEN reverse(text) ELSE text END), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM documents),
{_COVERS.format(a="'de'", b="'la'")}
SELECT doc_id::VARCHAR || '_0000' AS chunk_id, score FROM s ORDER BY score DESC, chunk_id LIMIT 20""")
def index_follows_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents loaded and indexed; then a third of them again with other texts, half of these before a refresh and half after it: hits are those of the tables as they stand."""
    own = store.Store(spark, _folder(spark), buckets=8)
    indexes = Indexes(own, _folder(spark))
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("filename"), F.lit("2024-05-06").alias("document_date"), "text", "doc_id")
    chunks = docs.select(F.concat("document_id", F.lit("_0000")).alias("chunk_id"), "document_id", "text", F.array(F.sin("doc_id"), F.cos("doc_id")).alias("embedding"), "doc_id")
    for again, half in ((False, None), (True, 0), (True, 3)):
        some = lambda x: x.where(F.pmod("doc_id", F.lit(6)) == half) if again else x  # noqa: B023, E731
        own.load(some(docs), some(chunks).withColumn("text", F.reverse("text") if again else F.col("text")), 2)
        if half != 3:
            indexes.refresh()
    version = own.version()
    found = indexes.at(version).lexical(own.frame(version, "chunks").select("chunk_id"), "de la", 200)
    return found.select("chunk_id", F.round("lexical_score", 6).alias("score")).orderBy(F.desc("score"), "chunk_id").limit(20)


@_query("""
WITH p AS (SELECT e.vec_id, q.vec_id AS q, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 12) AS s FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 100) q)
SELECT q::VARCHAR AS query, vec_id, row_number() OVER (PARTITION BY q ORDER BY s DESC, vec_id)::INTEGER AS rank, round(s, 5) AS score FROM p QUALIFY rank <= 20""")
def many_vectors_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of each of a hundred query vectors, all vectors read once."""
    rows = _read(spark, sf_dir, "embeddings")
    asked = {str(r["vec_id"]): r["embedding"] for r in rows.where("vec_id < 100").collect()}
    return many.vector_recall(rows, asked, 20, id_col="vec_id").select("query", "vec_id", "rank", F.round("vector_score", 5).alias("score"))


def _workbook(rows: list[tuple[int, str, str]], roles: list[str]) -> bytes:
    """A workbook of (day, role, text): dates as styled numbers, a column for each role."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    text = lambda at, x: f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(x)}</t></is></c>'
    names = "".join(text(f"{chr(66 + i)}3", x) for i, x in enumerate(roles))
    body = "".join(f'<row r="{k}"><c r="A{k}" s="1"><v>{day}</v></c>{text(f"{chr(66 + roles.index(role))}{k}", x)}</row>' for k, (day, role, x) in enumerate(rows, 4))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData><row r="3">{text("A3", "Fecha")}{names}</row>{body}</sheetData></worksheet>')
    return out.getvalue()


@_query("""
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS position, strftime(DATE '2023-11-14' + turn::INTEGER, '%Y-%m-%d') AS chunk_date, role AS section, '[' || strftime(DATE '2023-11-14' + turn::INTEGER, '%Y-%m-%d') || ' - ' || role || ']' || chr(10) || trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS text
FROM conversations WHERE role IN ('system', 'user', 'assistant') AND length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) >= 10""")
def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook made of each conversation, a row for each turn and a column for each role, and its narrative cells."""
    roles = ["system", "user", "assistant"]

    def made(key: tuple, turns: pd.DataFrame) -> pd.DataFrame:
        turns = turns.sort_values("turn")
        content = _workbook([(45244 + int(t), r, x) for t, r, x in zip(turns["turn"], turns["role"], turns["text"])], roles)
        return pd.DataFrame({"path": [str(key[0])], "relative": [str(key[0])], "filename": [f"{key[0]}.xlsx"], "content": [content]})

    turns = _read(spark, sf_dir, "conversations").where(F.col("role").isin(roles) & F.col("text").isNotNull())
    books = turns.groupBy("conv_id").applyInPandas(made, "path string, relative string, filename string, content binary")
    cells = files.sheet_chunks(books).where("text is not null")
    return cells.select(F.col("path").cast("long").alias("conv_id"), F.col("position_in_doc").alias("position"), "chunk_date", F.col("section_title_raw").alias("section"), "text")


@_query("""
SELECT 'type' AS kind, lang AS name, sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS n FROM documents GROUP BY lang
UNION ALL SELECT 'section', CASE WHEN doc_id % 3 = 0 THEN 'RIESGOS' ELSE source END, sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END)::BIGINT FROM documents GROUP BY ALL
UNION ALL SELECT 'documents', NULL, count(*) FROM documents
UNION ALL SELECT 'high', NULL, (sum(CASE WHEN n_chars >= 3000 THEN CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END ELSE 0 END))::BIGINT FROM documents""")
def kept_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a chunk each, counted; then a third of them again with two chunks each, of which the report knows without a refresh."""
    own = store.Store(spark, _folder(spark), buckets=8)
    kept = Reports(own, _folder(spark))
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("lang").alias("doc_type_category"), F.lit("2024-05-06").alias("document_date"), "doc_id", "source", F.least(F.lit(1.0), F.col("n_chars") / 5000).alias("importance_score"))
    for again in (False, True):
        some = docs.where("doc_id % 3 = 0") if again else docs
        chunks = some.select(F.explode(F.sequence(F.lit(0), F.lit(int(again)))).alias("i"), "*")
        own.load(some, chunks.select(F.concat_ws("_", "document_id", "i").alias("chunk_id"), "document_id", F.lit("RIESGOS").alias("section_type") if again else F.col("source").alias("section_type"), "importance_score", F.array(F.lit(1.0)).alias("embedding")), 1)
        if not again:
            kept.refresh()
    return kept.counts().where("kind in ('type', 'section', 'documents', 'high')").select("kind", "name", "n")


@_query("SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE source IN ('src0', 'src1', 'src5') AND lang NOT IN ('en', 'fr') AND quality = 1")
def institution_and_type_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institutions asked for, types left out."""
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.col("lang").alias("doc_type_category"), F.col("source").alias("institution"), F.col("quality").cast("double").alias("importance_score"))
    own = filters.AdvancedFilters.from_dict({"institutions": ["src0", "src1", "src5"], "exclude_doc_types": ["en", "fr"], "min_importance": 1.0})
    return rows.where(own.predicate()).select("doc_id")


@_query("WITH s AS (SELECT list_sort(list(o_totalprice)) AS s FROM orders) SELECT s[1] AS min, s[len(s) // 4 + 1] AS p25, s[len(s) // 2 + 1] AS p50, s[3 * len(s) // 4 + 1] AS p75, s[9 * len(s) // 10 + 1] AS p90, s[-1] AS max FROM s")
def price_order_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of a column whose values are nearly all different."""
    return stats.order_statistics(_read(spark, sf_dir, "orders"), "o_totalprice").drop("mean")
