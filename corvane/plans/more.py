"""More queries of the catalogue: filters, joins, files, tables and whole searches, and SQL that recomputes them."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions import vectors as V
from corvane.functions.taxonomy import MONITOR_SECTIONS
from corvane.operators import chunking, embed, enrich, filters, index, many, stats
from corvane.plans import parse, search
from corvane.plans.catalog import _ENRICHED, _FOLD, _WORDS, STOP_WORDS, _line_chunks, _query, _read, _vector
from corvane.sources import files, store


def _folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; it goes when the driver ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = f"{shared or 'file://' + tempfile.gettempdir()}/corvane-tables-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


# Text.

_LINES = "SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents"


@_query(f"SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, t AS paragraph FROM ({_LINES}) WHERE t <> ''")
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs between blank lines; each line end of the texts is made one."""
    return _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.paragraphs(F.regexp_replace("text", "\n", "\n \n"))).alias("pos", "paragraph"))


@_query(rf"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+([A-ZÁÉÍÓÚÑ0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM documents),
u AS (SELECT doc_id, trim(unnest(parts), ' ' || chr(9) || chr(10) || chr(13)) AS sentence, generate_subscripts(parts, 1) AS i FROM s)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, sentence FROM u WHERE sentence <> ''""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))


@_query(r"""
WITH p AS (SELECT conv_id, turn, role, trim(replace(text, chr(10), ' ')) AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS page FROM conversations)
SELECT conv_id, page, section, n_chars FROM (
  SELECT conv_id, page, last_value(CASE WHEN role = 'user' THEN 'TURNO ' || chr(65 + (turn % 26)::INTEGER) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY page ROWS UNBOUNDED PRECEDING) AS section, length(t) AS n_chars FROM p) WHERE n_chars > 0""")
def sections_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles name the section of the units after them, across pages: a user's turn begins with a title."""
    title = F.when(F.col("role") == "user", F.concat(F.lit("TURNO "), F.char((65 + F.col("turn") % 26).cast("int")), F.lit("\n\n"))).otherwise("")
    page = F.concat(title, F.replace("text", F.lit("\n"), F.lit(" ")))
    talks = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", page.alias("page")))), lambda x: x["page"]).alias("pages"))
    units = talks.select("conv_id", chunking.units(F.col("pages"), longest=1 << 30, clean=False).alias("units"))
    return units.select("conv_id", F.explode("units").alias("u")).select("conv_id", "u.page", "u.section", F.char_length("u.text").cast("long").alias("n_chars"))


@_query("SELECT doc_id, CASE WHEN length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) < 500 THEN 'little text: scanned?' ELSE '' END AS warnings FROM documents")
def scan_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.array("text").alias("pages"), F.array().cast("array<string>").alias("extraction_warnings"))
    return files.with_warnings(rows).select("doc_id", F.array_join("extraction_warnings", ",").alias("warnings"))


@_query("SELECT min(c_custkey) AS header_row, arg_min(c_mktsegment, c_custkey) AS second FROM customer WHERE c_custkey % 3 = 2 AND c_mktsegment <> ''")
def sheet_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row with two filled cells; of three customers, one keeps both."""
    k = F.col("c_custkey") % 3
    rows = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row"), F.array(F.when(k > 0, F.col("c_name")), F.when(k == 2, F.col("c_mktsegment")).otherwise(" ")).alias("cells"))
    return chunking.header_row(rows).select("header_row", F.element_at("cells", 2).alias("second"))


@_query(f"{_FOLD} SELECT doc_id, len(c)::INTEGER AS total_in_doc FROM m")
def chunks_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_chunks(spark, sf_dir).select(F.col("document_id").alias("doc_id"), "total_in_doc").distinct()


@_query()
def production_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunking of every text as one page with its production parameters; the break between sentences is tested against plain code."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.array("text").alias("pages"))
    return chunking.chunk_documents(docs, "doc_id").select(F.col("document_id").alias("doc_id"), "position_in_doc", "text", "section_title_raw", "total_in_doc")


# Queries as text.

@_query(f"""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '20%y-%m-%d') END AS exact_date, CASE WHEN k < 3 THEN month(d)::INTEGER END AS month,
  CASE k WHEN 1 THEN NULL WHEN 3 THEN year(d) - 1 ELSE year(d) END::INTEGER AS year_from, CASE k WHEN 1 THEN NULL ELSE year(d) END::INTEGER AS year_to,
  CASE k WHEN 0 THEN 'acta' WHEN 1 THEN 'acta x' WHEN 2 THEN 'minuta' ELSE 'fed' END AS clean_query, CASE k WHEN 2 THEN 'MINUTA' WHEN 3 THEN 'FED_STATEMENT' ELSE '' END AS doc_types
FROM d""")
def parsed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query parser over texts made of dates: spelled out, in figures, a month and year, a range of years."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    name = F.element_at(F.array(*map(F.lit, T.MONTHS)), F.month(d))
    text = (
        F.when(k == 0, F.concat(F.lit("acta "), F.dayofmonth(d), F.lit(" de "), name, F.lit(" de "), F.year(d)))
        .when(k == 1, F.concat(F.lit("acta "), F.date_format(d, "dd-MM-yy"), F.lit(" x")))
        .when(k == 2, F.concat(F.lit("minuta "), name, F.lit(" "), F.year(d)))
        .otherwise(F.concat(F.lit("fed "), F.year(d), F.lit(" a "), F.year(d) - 1))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            got = [parse.parse_query(t, STOP_WORDS) for t in rows["text"]]
            out = pd.DataFrame({"o_orderkey": rows["o_orderkey"], **{c: [g[c] for g in got] for c in ("exact_date", "month", "year_from", "year_to", "clean_query")}, "doc_types": [",".join(g["doc_types"]) for g in got]})
            yield out.astype({c: "Int32" for c in ("month", "year_from", "year_to")})

    return _read(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")).mapInPandas(run, "o_orderkey long, exact_date string, month int, year_from int, year_to int, clean_query string, doc_types string")


# Enrichment with documents.

@_query(f"""
{_ENRICHED}
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'REPORTE_RESEARCH' WHEN doc_id % 2 = 0 THEN 'MONITOR_PM' ELSE 'MINUTA' END AS doc_type_category, CASE WHEN doc_id % 5 = 0 THEN 'unknown' ELSE source END AS institution,
  CASE WHEN doc_id % 5 > 0 AND doc_id % 2 = 0 AND doc_id % 3 = 0 THEN 'RENTA_FIJA' WHEN doc_id % 5 > 0 AND doc_id % 2 = 0 AND doc_id % 3 = 1 THEN 'MERCADO_CAMBIARIO' ELSE section_type END AS section_type
FROM (SELECT d.*, o.source FROM d JOIN documents o USING (doc_id))""")
def monitor_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of chunks beside their documents, a fifth of which are missing; titles of a market monitor name the section."""
    docs = _read(spark, sf_dir, "documents")
    titles = F.element_at(F.array(*map(F.lit, ("Renta Fija", "Mercado Cambiario", "Nada"))), (F.col("doc_id") % 3 + 1).cast("int"))
    chunks = docs.select(F.col("doc_id").alias("document_id"), F.col("doc_id").cast("string").alias("chunk_id"), "text", F.lit(0).alias("position_in_doc"), F.lit(1).alias("total_in_doc"), titles.alias("section_title_raw"))
    known = docs.where("doc_id % 5 > 0").select(F.col("doc_id").alias("document_id"), F.when(F.col("doc_id") % 2 == 0, "MONITOR_PM").otherwise("MINUTA").alias("doc_type_category"), F.col("source").alias("institution"), F.lit(None).cast("string").alias("document_date"))
    rich = enrich.enrich_chunks(chunks, known, replace(STOP_WORDS, monitor_sections=MONITOR_SECTIONS))
    return rich.select(F.col("document_id").alias("doc_id"), "doc_type_category", "institution", "section_type")


COUNTED = ("the", "of", "la", "und")


def _word_counts():  # noqa: ANN202
    def encode(texts: list[str]) -> tuple[np.ndarray, list[int]]:
        words = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
        return np.array([[w.count(c) for c in COUNTED] for w in words], np.float32).reshape(-1, len(COUNTED)), [len(w) for w in words]

    return encode


@_query(f"""
{_WORDS}, c AS (SELECT doc_id, len(words)::INTEGER AS n_tokens, [{", ".join(f"len(list_filter(words, lambda x: x = '{w}'))" for w in COUNTED)}]::DOUBLE[] AS v FROM w)
SELECT doc_id, n_tokens, {", ".join(f"round(v[{i + 1}] / greatest(1e-9, sqrt(list_inner_product(v, v))), 4) AS v{i}" for i in range(len(COUNTED)))} FROM c""")
def embedded_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference over whole texts with a model that counts words, which SQL can recompute: unit vectors and token counts."""
    rows = embed.with_vectors(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _word_counts, "counts", text_col="text")
    return rows.select("doc_id", "n_tokens", *[F.round(F.col("embedding")[i].cast("double"), 4).alias(f"v{i}") for i in range(len(COUNTED))])


# Filters.

_DAY = "1995-03-05"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chunks: a third has a date of its own, a third only its document's, a third another one there."""
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 3
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k == 0, d).alias("chunk_date"),
        F.when(k == 1, d.cast("string")).when(k == 2, "1995").otherwise(F.lit(_DAY)).alias("document_date"),
        F.year(d).alias("document_year"),
        F.col("o_orderstatus").alias("doc_type_category"),
        F.col("o_orderpriority").alias("section_type"),
        F.col("o_orderstatus").alias("institution"),
        F.least(F.lit(1.0), F.col("o_totalprice") / 400000).alias("importance_score"),
        (F.col("o_orderkey") % 10 / 10).alias("section_confidence"),
        F.lit("plain.pdf").alias("filename"),
    )


_DATED = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE END AS chunk_date, CASE o_orderkey % 3 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '1995' ELSE '{_DAY}' END AS document_date,
  year(o_orderdate) AS document_year, o_orderpriority AS section_type, least(1.0::DOUBLE, o_totalprice / 400000) AS importance_score, o_orderkey % 10 / 10.0::DOUBLE AS section_confidence FROM orders"""


@_query(f"SELECT o_orderkey FROM ({_DATED}) WHERE chunk_date = DATE '{_DAY}' OR document_date = '{_DAY}'")
def exact_date_before_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).where(filters.search_filter({"exact_date": _DAY})).select("o_orderkey")


@_query(f"SELECT o_orderkey FROM ({_DATED}) WHERE CASE WHEN chunk_date IS NOT NULL THEN chunk_date = DATE '{_DAY}' ELSE document_date = '{_DAY}' END")
def exact_date_after_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).where(filters.matches_exact_date(_DAY)).select("o_orderkey")


@_query(f"SELECT section_type, count(*) AS n FROM ({_DATED}) WHERE section_type IN ('1-URGENT', '2-HIGH') GROUP BY section_type")
def section_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).where(filters.search_filter({"sections": ["1-URGENT", "2-HIGH"]})).groupBy("section_type").agg(F.count("*").alias("n"))


@_query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS distinct_keys FROM orders")
def no_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query without filters lets every row pass, and so do explicit filters that are empty."""
    rows = _dated(spark, sf_dir).where(filters.search_filter(parse.parse_query("algo", STOP_WORDS))).where(filters.AdvancedFilters().predicate())
    return rows.agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("distinct_keys"))


@_query(f"SELECT o_orderkey FROM ({_DATED}) WHERE coalesce(year(chunk_date), document_year) IN (1995, 1997)")
def years_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).where(filters.AdvancedFilters.from_dict({"years": [1995, 1997]}).predicate()).select("o_orderkey")


@_query(f"SELECT o_orderkey FROM ({_DATED}) WHERE section_confidence >= 0.4")
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).where(filters.AdvancedFilters.from_dict({"min_confidence": 0.4}).predicate()).select("o_orderkey")


@_query("SELECT doc_id FROM (SELECT doc_id, quality * n_chars / 4000.0 AS i FROM documents JOIN labels USING (doc_id)) WHERE i > 0 AND i <= 1")
def boilerplate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id").select("doc_id", (F.col("quality") * F.col("n_chars") / 4000.0).alias("importance_score"))
    return rows.where(filters.AdvancedFilters.from_dict({"exclude_boilerplate": True}).predicate()).select("doc_id")


@_query(f"SELECT o_orderkey FROM ({_DATED}) WHERE CASE WHEN chunk_date IS NOT NULL THEN month(chunk_date) WHEN document_date <> '1995' THEN month(try_cast(document_date AS DATE)) END IN (3, 7) AND importance_score BETWEEN 0.2 AND 0.8 AND section_confidence >= 0.3")
def months_after_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is decided on recalled rows: months, importance and confidence again."""
    own = filters.AdvancedFilters.from_dict({"months": [3, 7], "min_importance": 0.2, "max_importance": 0.8, "min_confidence": 0.3})
    return _dated(spark, sf_dir).where(own.after_recall()).select("o_orderkey")


# Joins, tables and files.


@_query("SELECT d.doc_id, d.source AS filename, d.lang AS doc_type_category, 2020 AS document_year, l.quality FROM labels l JOIN documents d USING (doc_id)")
def chunks_with_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("document_id"), "quality", F.lit("old").alias("filename"))
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("filename"), F.col("lang").alias("doc_type_category"), F.lit(2020).alias("document_year"))
    return search.joined(chunks, docs).select(F.col("document_id").alias("doc_id"), "filename", "doc_type_category", "document_year", "quality")


@_query("SELECT doc_id::VARCHAR AS document_id, source AS filename, text AS filepath, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE n_chars::INTEGER END AS total_pages FROM documents")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON and read back, texts with line ends and nulls among them."""
    folder = f"{_folder(spark)}/json"
    rows = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("filename"), F.col("text").alias("filepath"), F.when(F.col("doc_id") % 3 > 0, F.col("n_chars")).cast("int").alias("total_pages"))
    store.write_json(rows, folder)
    return store.read_documents_json(spark, folder).select("document_id", "filename", "filepath", "total_pages")


def _stored(spark: SparkSession, sf_dir: str) -> store.Store:
    """All documents with a vector each, loaded; then those that are divisible by 3 again, under another name and with shorter texts."""
    own = store.Store(spark, _folder(spark), buckets=8)
    own.setup()
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "embeddings"), F.col("doc_id") == F.col("vec_id"))
    docs = rows.select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("filename"), F.when(F.col("doc_id") % 2 == 0, "2021-05-06").otherwise("n/a").alias("document_date"), "doc_id")
    chunks = rows.select(F.concat("doc_id", F.lit("_0000")).alias("chunk_id"), F.col("doc_id").cast("string").alias("document_id"), "text", F.when(F.col("doc_id") % 7 > 0, F.col("embedding")).alias("embedding"), "doc_id")
    own.load(docs, chunks, 64)
    own.load(docs.where("doc_id % 3 = 0").withColumn("filename", F.lit("again")), chunks.where("doc_id % 3 = 0").withColumn("text", F.substring("text", 1, 10)), 64)
    return own


@_query("SELECT doc_id::VARCHAR AS document_id, CASE WHEN doc_id % 3 = 0 THEN 'again' ELSE source END AS filename, CASE WHEN doc_id % 2 = 0 THEN 2021 END AS document_year FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)")
def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).read("documents").select("document_id", "filename", "document_year")


@_query("SELECT doc_id || '_0000' AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN substring(text, 1, 10) ELSE text END AS text, 'CONTENIDO' AS section_type FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings) AND doc_id % 7 > 0")
def stored_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks without a vector are left out; a reload replaces its documents' chunks; missing columns get their defaults."""
    return _stored(spark, sf_dir).read("chunks").select("chunk_id", "text", "section_type")


@_query("SELECT doc_id::VARCHAR AS filename, quality = 0 AS failed, CASE WHEN toxic = 1 THEN 'w' END AS warning FROM labels WHERE quality = 0 OR toxic = 1")
def extraction_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "labels").select(F.col("quality").alias("total_chunks"), F.array_compact(F.array(F.when(F.col("toxic") == 1, "w"))).alias("extraction_warnings"), F.col("doc_id").cast("string").alias("filename"))
    return stats.extraction_warnings(rows)


@_query("SELECT count(*) FILTER (vec_id % 50 = 0) AS queries, true AS reached FROM embeddings")
def index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate index finds 0.9 of the 20 true neighbours of every fiftieth row, on average."""
    rows = _read(spark, sf_dir, "embeddings")
    own = index.build(rows.select("vec_id", "embedding"), f"{_folder(spark)}/index", id_col="vec_id")
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("x"))
    found, true = own.near_many(asked, 20, id_col="vec_id"), many.nearest(rows, asked, 20, own.centroids.shape[1])
    both = true.select("query", "vec_id").join(found.select("query", "vec_id", F.lit(1).alias("found")), ["query", "vec_id"], "left")
    hits = both.agg(F.count_if(F.col("found").isNotNull()).alias("hits"), F.count("*").alias("total"))
    return asked.agg(F.count("*").alias("queries")).join(hits).select("queries", (F.col("hits") >= 0.9 * F.col("total")).alias("reached"))


# Whole searches: the embeddings table gives the vectors, and SQL recomputes every step.

_LEXICAL = """
hw AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w WHERE doc_id IN (SELECT vec_id FROM embeddings)) WHERE word IN ('from', 'with')),
lw AS (SELECT doc_id, pos, least(max(CASE WHEN word = 'from' THEN pos END) OVER o, max(CASE WHEN word = 'with' THEN pos END) OVER o) AS low, max(CASE WHEN word = 'from' THEN pos END) OVER o AS f, max(CASE WHEN word = 'with' THEN pos END) OVER o AS g FROM hw WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
cw AS (SELECT doc_id, low, min(pos) AS high FROM lw WHERE f IS NOT NULL AND g IS NOT NULL GROUP BY doc_id, low),
nw AS (SELECT cw.doc_id, cw.low, cw.high, count(*) AS hits FROM cw JOIN hw ON hw.doc_id = cw.doc_id AND hw.pos BETWEEN cw.low AND cw.high GROUP BY ALL),
lex AS (SELECT doc_id, list_sum(list(0.1::DOUBLE / (1 + high - low + 1 - hits) ORDER BY high)) AS score FROM nw GROUP BY doc_id),
lexr AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, printf('%08d', doc_id)) AS r FROM lex QUALIFY r <= 50)"""
_NEAR = "vecr AS (SELECT d.doc_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s, e.embedding::DOUBLE[] AS v, least(1.0::DOUBLE, d.n_chars / 4000.0::DOUBLE) AS imp, row_number() OVER (ORDER BY s DESC, d.doc_id) AS r FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)"


def _searched(spark: SparkSession, sf_dir: str, query: str, **options) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "embeddings"), F.col("doc_id") == F.col("vec_id"))
    chunks = rows.select(F.format_string("%08d_0000", "doc_id").alias("chunk_id"), F.col("doc_id").alias("document_id"), "text", F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), F.lit(None).cast("date").alias("chunk_date"), F.lit("CONTENIDO").alias("section_type"), F.lit(1.0).alias("section_confidence"), F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("importance_score"), F.map_from_arrays(F.array(F.lit("NONE")), F.array(F.lit(1))).alias("economic_variables"), "embedding")
    documents = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("filename"), F.col("lang").alias("doc_type_category"), F.col("source").alias("institution"), F.lit("2020-01-02").alias("document_date"), F.lit(2020).alias("document_year"))
    vector = _vector(spark, sf_dir, 0)
    if options.pop("advanced", False):
        return search.advanced_search(chunks, documents, filters.AdvancedFilters.from_dict({"doc_types": ["en"], "min_importance": 0.2}), query, 10)
    return search.search(chunks, documents, query, lambda q: vector, 10, taxonomy=STOP_WORDS, **options)[0]


@_query(f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words FROM documents), {_LEXICAL}, {_NEAR},
fusedw AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(1.0::DOUBLE / (60 + a.r), 0) + coalesce(1.0::DOUBLE / (60 + b.r), 0) AS rrf, CASE WHEN a.r IS NULL THEN 1 ELSE 0 END AS l, coalesce(a.r, b.r) AS r FROM (SELECT * FROM vecr WHERE r <= 50) a FULL JOIN lexr b ON a.doc_id = b.doc_id),
cand AS (SELECT f.doc_id, f.rrf, row_number() OVER (ORDER BY f.rrf DESC, f.l, f.r) AS ord, list_inner_product(e.v, q.embedding::DOUBLE[]) AS sim, e.v, e.imp FROM fusedw f JOIN vecr e USING (doc_id), (SELECT embedding FROM embeddings WHERE vec_id = 0) q),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, list_inner_product(x.v, y.v) AS s FROM cand x, cand y),
chosen AS (
  SELECT 1 AS step, [arg_max(doc_id, struct_pack(s := sim, o := -ord))] AS ids FROM cand
  UNION ALL
  SELECT step + 1, list_append(ids, arg_max(doc_id, struct_pack(s := score, o := -ord)))
  FROM (SELECT c.step, c.ids, d.doc_id, d.ord, 0.65::DOUBLE * d.sim - (1 - 0.65::DOUBLE) * max(p.s) AS score
        FROM chosen c JOIN cand d ON NOT list_contains(c.ids, d.doc_id) JOIN pair p ON p.a = d.doc_id AND list_contains(c.ids, p.b) WHERE c.step < 20 GROUP BY c.step, c.ids, d.doc_id, d.ord, d.sim)
  GROUP BY step, ids),
picked AS (SELECT unnest(arg_max(ids, step)) AS doc_id FROM chosen)
SELECT printf('%08d_0000', doc_id) AS chunk_id, doc_id AS document_id, round(rrf + 0.15::DOUBLE * imp, 9) AS final_score, rrf + 0.15::DOUBLE * imp < 0.05 AS low_confidence FROM picked JOIN cand USING (doc_id) ORDER BY rrf + 0.15::DOUBLE * imp DESC, chunk_id LIMIT 10""")
def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of search(): year filter, two recalls, fusion, marginal relevance, boost."""
    return _searched(spark, sf_dir, "from with 2020").select("chunk_id", "document_id", F.round("final_score", 9).alias("final_score"), "low_confidence")


@_query(f"WITH {_NEAR} SELECT doc_id AS document_id, round(1.0::DOUBLE / (60 + r) + 0.15::DOUBLE * imp, 9) AS final_score FROM vecr WHERE r <= 50 ORDER BY 1.0::DOUBLE / (60 + r) + 0.15::DOUBLE * imp DESC, doc_id LIMIT 10")
def relaxed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section and a variable that no chunk has: both are dropped and recall runs again; without marginal relevance."""
    return _searched(spark, sf_dir, "zzz la", use_mmr=False).select("document_id", F.round("final_score", 9).alias("final_score"))


@_query("SELECT doc_id AS document_id FROM documents WHERE false")
def search_of_another_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year that no document has: relaxation doesn't help, and neither does the fallback, which keeps the filters."""
    return _searched(spark, sf_dir, "la 1999").select("document_id")


@_query(f"""
{_WORDS}, {_LEXICAL.partition("lexr AS")[0].rstrip().rstrip(",")}
SELECT doc_id AS document_id, round(score, 6) AS score FROM lex JOIN documents USING (doc_id) WHERE lang = 'en' AND least(1.0::DOUBLE, n_chars / 4000.0::DOUBLE) >= 0.2 ORDER BY lex.score DESC, printf('%08d', doc_id) LIMIT 10""")
def advanced_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit filters and a full-text query without a model."""
    return _searched(spark, sf_dir, "from with", advanced=True).select("document_id", F.round("lexical_score", 6).alias("score"))
