"""Queries over the driver's tables, one or more for each operator, and SQL that recomputes them.

The tables hold invented words, so the taxonomy here is one of real stop words,
and lines stand for paragraphs. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions import vectors as V
from corvane.functions.taxonomy import Taxonomy
from corvane.operators import chunking, enrich, filters, fuse, recall, stats
from corvane.plans import prompt
from corvane.sources import store

STOP_WORDS = Taxonomy(
    variables={"ENGLISH": ("CRITICAL", ["the", "of the"]), "AND": ("CRITICAL", ["and"]), "SPANISH": ("HIGH", ["la", "de la"]), "GERMAN": ("MEDIUM", ["und"])},
    sections={"DECISION": ["the", "is"], "PROYECCION": ["la", "de la"], "RIESGOS": ["und", "der"], "ANALISIS": ["le", "les"]},
    entities={"VERB": ["es", "is"], "ARTICLE": ["el", "le"]},
    forward=["with", "que"],
    boilerplate=["all rights reserved"],
)
NUMBERS = ((r"(\d{1,4})", "number"),)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vector(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    """The query vector: one row."""
    return list(_read(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id).first()["embedding"])


# SQL fragments, made from the same taxonomy.


def _normal(x: str = "text") -> str:
    return rf"trim(regexp_replace(strip_accents(lower({x})), '\s+', ' ', 'g'))"


def _count(normal: str, words: list[str]) -> str:
    """Whole-word matches: each other character is doubled, so that neighbours don't share a border."""
    import re

    doubled = "|".join(re.sub(r"([^a-z0-9])", r"\1\1", w) for w in words)
    return rf"len(regexp_extract_all(' ' || regexp_replace({normal}, '([^a-z0-9])', '\1\1', 'g') || ' ', '[^a-z0-9](?:{doubled})[^a-z0-9]'))"


_SCORES = ", ".join(f"{_count('t', w)} AS s_{n}" for n, w in STOP_WORDS.sections.items())
_VARS = ", ".join(f"{_count('t', w)} AS v_{n}" for n, (_, w) in STOP_WORDS.variables.items())
_ENTS = ", ".join(f"{_count('t', w)} AS e_{n}" for n, w in STOP_WORDS.entities.items())
_BASE = f"WITH base AS (SELECT *, {_normal()} AS t FROM documents)"


# Vector recall, fusion, diversity, boost.

_TOP = "SELECT e.vec_id, e.label, e.embedding::DOUBLE[] AS v, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = {q}) q"


@_query(f"SELECT vec_id, round(s, 6) AS score FROM ({_TOP.format(q=0)}) ORDER BY s DESC, vec_id LIMIT 50")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = recall.vector_recall(_read(spark, sf_dir, "embeddings"), _vector(spark, sf_dir, 0), 50, id_col="vec_id")
    return hits.select("vec_id", F.round("vector_score", 6).alias("score"))


@_query(f"SELECT vec_id, label, round(s, 6) AS score FROM ({_TOP.format(q=3)}) WHERE label IN (1, 2, 3) ORDER BY s DESC, vec_id LIMIT 50")
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").where(F.col("label").isin(1, 2, 3))
    return recall.vector_recall(rows, _vector(spark, sf_dir, 3), 50, id_col="vec_id").select("vec_id", "label", F.round("vector_score", 6).alias("score"))


def _two_rankings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _read(spark, sf_dir, "embeddings")
    first = fuse.ranked(recall.vector_recall(rows, _vector(spark, sf_dir, 0), 50, id_col="vec_id"), "vector_score", id_col="vec_id")
    second = fuse.ranked(recall.vector_recall(rows, _vector(spark, sf_dir, 1), 50, id_col="vec_id"), "vector_score", id_col="vec_id")
    return first, second


_FUSED = f"""
a AS (SELECT vec_id, row_number() OVER (ORDER BY s DESC, vec_id) AS r FROM ({_TOP.format(q=0)}) QUALIFY r <= 50),
b AS (SELECT vec_id, row_number() OVER (ORDER BY s DESC, vec_id) AS r FROM ({_TOP.format(q=1)}) QUALIFY r <= 50),
fused AS (SELECT vec_id, coalesce(1.0::DOUBLE / (60 + a.r), 0) + coalesce(1.0::DOUBLE / (60 + b.r), 0) AS rrf, CASE WHEN a.r IS NULL THEN 1 ELSE 0 END AS l, coalesce(a.r, b.r) AS r FROM a FULL JOIN b USING (vec_id)),
cand AS (SELECT f.vec_id, f.rrf, row_number() OVER (ORDER BY f.rrf DESC, f.l, f.r) AS ord, e.s AS sim, e.v, e.label FROM fused f JOIN ({_TOP.format(q=0)}) e USING (vec_id))"""


@_query(f"WITH {_FUSED} SELECT vec_id, round(rrf, 9) AS rrf_score FROM fused")
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.rrf(_two_rankings(spark, sf_dir), id_col="vec_id").select("vec_id", F.round("rrf_score", 9).alias("rrf_score"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _two_rankings(spark, sf_dir)
    scores = fuse.rrf([first, second], id_col="vec_id")
    rows = scores.withColumn("order", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("rrf_score"), "first_list", "first_rank")))
    return _read(spark, sf_dir, "embeddings").join(F.broadcast(rows), "vec_id")  # 100 rows at most


_MMR = f"""
WITH RECURSIVE {_FUSED},
pair AS (SELECT x.vec_id AS a, y.vec_id AS b, list_inner_product(x.v, y.v) AS s FROM cand x, cand y),
chosen AS (
  SELECT 1 AS step, [arg_max(vec_id, struct_pack(s := sim, o := -ord))] AS ids FROM cand
  UNION ALL
  SELECT step + 1, list_append(ids, arg_max(vec_id, struct_pack(s := score, o := -ord)))
  FROM (SELECT c.step, c.ids, d.vec_id, d.ord, 0.65::DOUBLE * d.sim - (1 - 0.65::DOUBLE) * max(p.s) AS score
        FROM chosen c JOIN cand d ON NOT list_contains(c.ids, d.vec_id) JOIN pair p ON p.a = d.vec_id AND list_contains(c.ids, p.b)
        WHERE c.step < 10 GROUP BY c.step, c.ids, d.vec_id, d.ord, d.sim)
  GROUP BY step, ids),
picked AS (SELECT unnest(ids) AS vec_id, unnest(range(1, 11)) AS mmr_rank FROM chosen WHERE step = 10)"""


@_query(f"{_MMR} SELECT vec_id, mmr_rank::INTEGER AS mmr_rank FROM picked")
def mmr_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.mmr(_candidates(spark, sf_dir), _vector(spark, sf_dir, 0), 10, id_col="vec_id")


_BOOSTED = "rrf + 0.15::DOUBLE * (label / 10.0::DOUBLE)"


@_query(f"{_MMR} SELECT vec_id, round({_BOOSTED}, 9) AS final_score, {_BOOSTED} < 0.05 AS low_confidence FROM picked JOIN cand USING (vec_id) ORDER BY {_BOOSTED} DESC, vec_id LIMIT 5")
def hybrid_fusion_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two recalls, reciprocal rank fusion, marginal relevance, importance boost, top 5."""
    rows = _candidates(spark, sf_dir).withColumn("importance_score", F.col("label") / 10.0)
    rows = rows.join(fuse.mmr(rows, _vector(spark, sf_dir, 0), 10, id_col="vec_id"), "vec_id")
    return fuse.importance_boost(rows, 5, id_col="vec_id").select("vec_id", F.round("final_score", 9).alias("final_score"), "low_confidence")


@_query(f"WITH {_FUSED} SELECT vec_id, round({_BOOSTED}, 9) AS final_score, {_BOOSTED} < 0.05 AS low_confidence FROM cand ORDER BY {_BOOSTED} DESC, vec_id LIMIT 20")
def importance_boost_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir).withColumn("importance_score", F.col("label") / 10.0)
    return fuse.importance_boost(rows, 20, id_col="vec_id").select("vec_id", F.round("final_score", 9).alias("final_score"), "low_confidence")


@_query("SELECT vec_id, label FROM embeddings ORDER BY label DESC, vec_id LIMIT 20")
def importance_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("label").alias("importance_score"), F.lit(1).alias("page_start"))
    return recall.importance_recall(rows, 20, id_col="vec_id").select("vec_id", "label")


@_query("SELECT vec_id, round(list_sum(v[1:32]), 6) AS cut, len(v) + 16 AS padded FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)")
def dimension_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    total = F.aggregate(V.reconciled(v, 32), F.lit(0.0), lambda a, x: a + x)
    return _read(spark, sf_dir, "embeddings").select("vec_id", F.round(total, 6).alias("cut"), F.size(V.reconciled(v, 80)).cast("long").alias("padded"))


@_query("SELECT vec_id, '[' || array_to_string(list_transform(embedding::DOUBLE[], lambda x: printf('%.7f', x)), ',') || ']' AS literal, len(embedding)::INTEGER AS parsed FROM embeddings")
def vector_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    literal = V.formatted(F.col("embedding"))
    left_out = F.size(F.filter("embedding", lambda x: x.isNull()))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", literal.alias("literal"), left_out.alias("left_out"))
    return rows.select("vec_id", "literal", (F.coalesce(F.size(V.parsed(F.col("literal"))), F.lit(0)) + F.col("left_out")).alias("parsed"))


# Text functions.


@_query(f"SELECT doc_id, {_normal()} AS normal FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


@_query(r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(text, '-\n([\p{L}\p{N}_])', '\1', 'g'), chr(10), ' '), '[ \t]+', ' ', 'g'), '^\s*\d{1,3}\s*$', ''), '\{\[\{[^}]*\}\]\}', '', 'g'), ' ' || chr(10) || chr(9) || chr(13)) AS page
FROM documents""")
def page_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", T.normalize_page(F.col("text")).alias("page"))


@_query(rf"""SELECT page_id, trim(regexp_replace(lower(regexp_replace(url, '([^/])\.[^./]+$', '\1')), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM pages""")
def slug_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


_PATH = "CASE doc_id % 7 WHEN 0 THEN 'Comunicados/' WHEN 1 THEN 'Minutas/' WHEN 2 THEN 'Fed/' WHEN 3 THEN 'Monitor PM/' WHEN 4 THEN 'Research/JPM/' ELSE '' END || source || '.pdf'"


@_query(f"""
SELECT doc_id, CASE WHEN p LIKE '%comunicado%' THEN 'COMUNICADO' WHEN p LIKE '%minuta%' THEN 'MINUTA' WHEN p LIKE '%/fed/%' OR p LIKE 'fed/%' OR p LIKE '%reunion_fed%' THEN 'FED_STATEMENT'
  WHEN p LIKE '%monitor_pm%' OR p LIKE '%monitor pm%' THEN 'MONITOR_PM' ELSE 'REPORTE_RESEARCH' END AS doc_type,
  CASE WHEN p LIKE '%jpm%' THEN 'jpmorgan' WHEN p LIKE '%fed%' THEN 'federal_reserve' WHEN p LIKE '%comunicado%' OR p LIKE '%minuta%' OR p LIKE '%monitor_pm%' OR p LIKE '%monitor pm%' THEN 'banco_central_chile' ELSE 'unknown' END AS institution
FROM (SELECT doc_id, lower({_PATH}) AS p FROM documents)""")
def doc_type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.expr(_PATH).alias("path"))
    return docs.select("doc_id", T.document_type(F.col("path")).alias("doc_type"), T.institution(F.col("path")).alias("institution"))


@_query(r"""
WITH f AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, 'r_%Y-%m-%d.pdf') WHEN 1 THEN strftime(o_orderdate, 'r %d.%m.%Y') WHEN 2 THEN strftime(o_orderdate, 'c_%d-%m-%y.pdf')
  WHEN 3 THEN strftime(o_orderdate, 'annual %Y ') ELSE 'none' END AS n FROM orders)
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN regexp_extract(n, '(\d{4}-\d\d-\d\d)', 1)
  WHEN 1 THEN regexp_replace(n, 'r (\d\d)\.(\d\d)\.(\d{4})', '\3-\2-\1')
  WHEN 2 THEN CASE WHEN regexp_extract(n, '-(\d\d)\.pdf', 1)::INT < 50 THEN '20' ELSE '19' END || regexp_replace(n, 'c_(\d\d)-(\d\d)-(\d\d)\.pdf', '\3-\2-\1')
  WHEN 3 THEN regexp_extract(n, '(\d{4})', 1) END AS found FROM f""")
def date_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    name = F.when(k == 0, F.date_format(d, "'r_'yyyy-MM-dd'.pdf'")).when(k == 1, F.date_format(d, "'r 'dd.MM.yyyy")).when(k == 2, F.date_format(d, "'c_'dd-MM-yy'.pdf'")).when(k == 3, F.date_format(d, "'annual 'yyyy' '")).otherwise("none")
    return _read(spark, sf_dir, "orders").select("o_orderkey", T.detect_date(name, F.lit("")).alias("found"))


@_query(r"""
WITH n AS (SELECT doc_id, unnest(regexp_extract_all(text, '(\d{1,4})', 1)) AS value, generate_subscripts(regexp_extract_all(text, '(\d{1,4})', 1), 1) AS i FROM documents),
f AS (SELECT doc_id, value, min(i) AS i FROM n GROUP BY doc_id, value)
SELECT doc_id, value, 'number' AS unit, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos FROM f QUALIFY pos < 10""")
def numeric_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode_outer(T.numeric_values(F.col("text"), NUMBERS)).alias("pos", "n")).where("pos is not null")
    return rows.select("doc_id", "n.value", "n.unit", "pos")


@_query(r"""
SELECT o_orderkey, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '\b(19[8-9]\d|20[0-4]\d)\b', 1))), ',') AS years, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '(?i)\b(q[1-4])\b', 1))), ',') AS quarters
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d and 1999, 1875 ') || 'Q' || quarter(o_orderdate) AS t FROM orders)""")
def temporal_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd' and 1999, 1875 Q'"), F.quarter("o_orderdate").cast("string"))
    found = _read(spark, sf_dir, "orders").select("o_orderkey", T.temporal_refs(text).alias("r"))
    return found.select("o_orderkey", F.array_join("r.years", ",").alias("years"), F.array_join("r.quarters", ",").alias("quarters"))


# Enrichment.


@_query(f"""
{_BASE}, c AS (SELECT doc_id, unnest([{", ".join(f"struct_pack(name := '{n}', importance := '{lv}', mentions := {_count('t', w)})" for n, (lv, w) in STOP_WORDS.variables.items())}]) AS m FROM base)
SELECT doc_id, m.name, m.importance, m.mentions::INTEGER AS mentions, round(least(1.0::DOUBLE, 0.5::DOUBLE + 0.1::DOUBLE * (m.mentions - 1)), 2) AS confidence FROM c WHERE m.mentions > 0""")
def keyword_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal")).select("doc_id", enrich.variables(F.col("normal"), STOP_WORDS).alias("vars"))
    found = rows.select("doc_id", F.explode_outer("vars").alias("name", "m")).where("name is not null")
    return found.select("doc_id", "name", "m.importance", "m.mentions", "m.confidence")


@_query(f"""
{_BASE}, c AS (SELECT unnest([{", ".join(f"struct_pack(name := '{n}', mentions := {_count('t', w)})" for n, (_, w) in STOP_WORDS.variables.items())}]) AS m FROM base)
SELECT m.name, count(*) AS chunks FROM c WHERE m.mentions > 0 GROUP BY ALL ORDER BY chunks DESC, m.name LIMIT 10""")
def keyword_histogram_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select(T.normalize_text(F.col("text")).alias("normal")).select(enrich.variables(F.col("normal"), STOP_WORDS).alias("vars"))
    return stats.key_histogram(rows, "vars")


@_query(f"""
{_BASE}, c AS (SELECT doc_id, unnest([{", ".join(f"struct_pack(name := '{n}', mentions := {_count('t', w)})" for n, w in STOP_WORDS.entities.items())}]) AS m FROM base)
SELECT doc_id, m.name, m.mentions::INTEGER AS mentions FROM c WHERE m.mentions > 0""")
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal")).select("doc_id", enrich.entities(F.col("normal"), STOP_WORDS).alias("ents"))
    return rows.select("doc_id", F.explode_outer("ents").alias("name", "mentions")).where("name is not null")


_SECTION_SQL = (
    "CASE " + " ".join(f"WHEN s_{n} > 0 AND s_{n} = greatest({', '.join('s_' + m for m in STOP_WORDS.sections)}) THEN '{n}'" for n in STOP_WORDS.sections) + " ELSE 'ENCABEZADO' END"
)
_BEST, _SUM = f"greatest({', '.join('s_' + m for m in STOP_WORDS.sections)})", " + ".join("s_" + m for m in STOP_WORDS.sections)


@_query(f"{_BASE} SELECT doc_id, {_SECTION_SQL} AS section_type, CASE WHEN {_BEST} > 0 THEN round(least(1.0::DOUBLE, 0.40::DOUBLE + {_BEST} / ({_SUM} + 1)::DOUBLE), 2) ELSE 0.4::DOUBLE END AS confidence FROM (SELECT doc_id, {_SCORES} FROM base)")
def section_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich.section(F.col("normal"), F.lit(0), F.lit(1), F.lit(None).cast("string"), STOP_WORDS)
    return _read(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal")).select("doc_id", found.alias("f")).select("doc_id", F.col("f.type").alias("section_type"), F.col("f.confidence").alias("confidence"))


@_query("""
WITH p AS (SELECT conv_id, turn, turn / greatest(1, count(*) OVER (PARTITION BY conv_id) - 1)::DOUBLE AS rel FROM conversations)
SELECT conv_id, turn, CASE WHEN rel < 0.05 THEN 'ENCABEZADO' WHEN rel < 0.20 THEN 'CONTEXTO_EXTERNO' WHEN rel < 0.35 THEN 'ANALISIS' WHEN rel > 0.85 THEN 'RIESGOS' WHEN rel > 0.70 THEN 'PROYECCION' ELSE 'CONTENIDO' END AS band FROM p""")
def section_position_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").withColumn("n", F.count("*").over(Window.partitionBy("conv_id")))
    none = Taxonomy(sections={"DECISION": [" "]})
    return rows.select("conv_id", "turn", enrich.section(F.lit(""), F.col("turn"), F.col("n"), F.lit(None).cast("string"), none)["type"].alias("band"))


@_query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked_at FROM conversations")
def carry_forward_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(window).alias("asked_at"))


_NUMS = r"least(10, len(list_distinct(regexp_extract_all(text, '(\d{1,4})', 1))))"
_ENRICHED = f"""
{_BASE}, c AS (SELECT doc_id, t, {_NUMS} AS nums, {_count("t", STOP_WORDS.forward)} > 0 AS fwd, {_count("t", STOP_WORDS.boilerplate)} > 0 AS boiler, {_VARS}, {_ENTS}, {_SCORES} FROM base),
d AS (SELECT *, {_SECTION_SQL} AS section_type, (v_ENGLISH > 0)::INT + (v_AND > 0)::INT AS critical FROM c)"""


@_query(f"""
{_ENRICHED}
SELECT doc_id, CASE WHEN boiler THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
  CASE WHEN critical >= 2 THEN 0.35::DOUBLE + 0.10::DOUBLE WHEN critical = 1 THEN 0.35::DOUBLE WHEN v_SPANISH > 0 THEN 0.20::DOUBLE WHEN v_GERMAN > 0 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + 0.20::DOUBLE * least(1.0::DOUBLE, nums / 3.0::DOUBLE)
  + CASE WHEN section_type = 'DECISION' THEN 0.25::DOUBLE WHEN section_type IN ('PROYECCION', 'RIESGOS') THEN 0.15::DOUBLE WHEN section_type = 'ANALISIS' THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN fwd THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + 0.10::DOUBLE * least(1.0::DOUBLE, ((e_VERB > 0)::INT + (e_ARTICLE > 0)::INT) / 2.0::DOUBLE)
  - CASE WHEN critical = 0 AND v_SPANISH = 0 AND v_GERMAN = 0 AND nums = 0 THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END)), 3) END AS importance_score FROM d""")
def importance_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("doc_id", "importance_score")


@_query(f"""
{_ENRICHED}
SELECT doc_id, array_to_string(list_filter([CASE WHEN section_type = 'DECISION' THEN 'DECISION_POLITICA' END, CASE WHEN fwd THEN 'FORWARD_LOOKING' END, CASE WHEN nums > 0 THEN 'DATOS_NUMERICOS' END, CASE WHEN critical > 0 THEN 'VARIABLE_CRITICA' END], lambda x: x IS NOT NULL), ',') AS tags FROM d""")
def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("doc_id", F.array_join("tags", ",").alias("tags"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").withColumn("normal", T.normalize_text(F.col("text")))
    rows = rows.withColumn("counts", enrich.keyword_counts(F.col("normal"), STOP_WORDS))
    normal, own = F.col("normal"), F.col("counts")
    rows = rows.withColumns({"vars": enrich.variables(normal, STOP_WORDS, own), "ents": enrich.entities(normal, STOP_WORDS, own), "nums": T.numeric_values(F.col("text"), NUMBERS), "forward": enrich.forward(normal, STOP_WORDS, own)})
    rows = rows.withColumn("section_type", enrich.section(normal, F.lit(0), F.lit(1), F.lit(None).cast("string"), STOP_WORDS, own)["type"])
    return rows.withColumns({
        "importance_score": enrich.importance(normal, F.col("vars"), F.col("nums"), F.col("section_type"), F.col("ents"), F.col("forward"), STOP_WORDS, counts=own),
        "tags": enrich.tags(normal, F.col("vars"), F.col("nums"), F.col("section_type"), STOP_WORDS, own),
    })


@_query(f"""
{_ENRICHED}
SELECT doc_id, 'passage: [REPORTE_RESEARCH | ' || section_type || coalesce(' | ' || nullif(array_to_string(list_filter([CASE WHEN v_ENGLISH > 0 THEN 'ENGLISH' END, CASE WHEN v_AND > 0 THEN 'AND' END, CASE WHEN v_SPANISH > 0 THEN 'SPANISH' END, CASE WHEN v_GERMAN > 0 THEN 'GERMAN' END], lambda x: x IS NOT NULL)[1:3], ', '), ''), '') || '] ' AS prefix FROM d""")
def embed_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _enriched(spark, sf_dir).select("doc_id", F.lit("").alias("text"), "section_type", F.lit("REPORTE_RESEARCH").alias("doc_type_category"), F.col("vars").alias("economic_variables"))
    return enrich.embed_text(rows, "some-e5-model", STOP_WORDS).select("doc_id", F.col("embed_text").alias("prefix"))


# Chunking.

_FOLD = r"""
WITH RECURSIVE u AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE t <> ''),
f AS (
  SELECT DISTINCT doc_id, 0::BIGINT AS i, NULL::VARCHAR AS buf, 0::BIGINT AS len, []::VARCHAR[] AS done FROM u
  UNION ALL
  SELECT f.doc_id, f.i + 1, CASE WHEN f.buf IS NULL THEN u.t WHEN f.len + length(u.t) > 600 AND f.len >= 200 THEN right(f.buf, 100) || ' ' || u.t ELSE f.buf || ' ' || u.t END,
    CASE WHEN f.len + length(u.t) > 600 AND f.len >= 200 THEN least(100, length(f.buf)) ELSE f.len END + length(u.t) + 1,
    CASE WHEN f.len + length(u.t) > 600 AND f.len >= 200 THEN list_append(f.done, trim(f.buf)) ELSE f.done END
  FROM f JOIN u ON u.doc_id = f.doc_id AND u.i = f.i + 1),
l AS (SELECT doc_id, list_append(arg_max(done, i), trim(arg_max(buf, i))) AS c FROM f GROUP BY doc_id),
m AS (SELECT doc_id, CASE WHEN len(c) >= 2 AND length(c[-1]) < 200 THEN list_append(c[:-3], c[-2] || ' ' || c[-1]) ELSE c END AS c FROM l)"""


def _line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.array("text").alias("pages"))
    return chunking.chunk_documents(docs, "doc_id", longest=1 << 30, paragraph_break="\n", clean=False)


@_query(f"{_FOLD} SELECT doc_id, unnest(range(len(c)))::INTEGER AS position_in_doc, unnest(c) AS text FROM m")
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_chunks(spark, sf_dir).select(F.col("document_id").alias("doc_id"), "position_in_doc", "text")


@_query(f"{_FOLD}, n AS (SELECT length(unnest(c)) AS x FROM m), s AS (SELECT list_sort(list(x)) AS s, sum(x) AS total FROM n) SELECT s[1] AS min, s[len(s) // 4 + 1] AS p25, s[len(s) // 2 + 1] AS p50, s[3 * len(s) // 4 + 1] AS p75, s[9 * len(s) // 10 + 1] AS p90, s[-1] AS max, (total // len(s))::BIGINT AS mean FROM s")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.order_statistics(_line_chunks(spark, sf_dir), "char_count")
    return found.select(*[F.col(c).cast("long").alias(c) for c in found.columns])


@_query(f"{_FOLD} SELECT doc_id, len(c) AS total_chunks, list_sum(list_transform(c, lambda x: length(x)))::BIGINT AS char_count FROM m")
def document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _line_chunks(spark, sf_dir).withColumn("chunk_date", F.lit(None).cast("string"))
    return stats.document_totals(rows).select(F.col("document_id").alias("doc_id"), "total_chunks", "char_count")


@_query("SELECT c_custkey, header, text FROM (UNPIVOT (SELECT c_custkey, c_name, c_mktsegment FROM customer) ON c_name, c_mktsegment INTO NAME header VALUE text) WHERE length(text) >= 10")
def unpivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Fecha"), "c_name", "c_mktsegment")
    return chunking.sheet_cells(wide).select(F.col("chunk_date").cast("long").alias("c_custkey"), "header", "text")


@_query("SELECT doc_id, greatest(1, length(text) // 4)::INTEGER AS estimate, printf('doc%d_%04d', doc_id, doc_id % 10) AS chunk_id FROM documents")
def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("estimate"), F.format_string("doc%d_%04d", F.col("doc_id"), F.col("doc_id") % 10).alias("chunk_id"))


# Lexical recall.

_WORDS = r"WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM documents)"


@_query(f"{_WORDS} SELECT doc_id FROM w WHERE list_contains(words, 'the') AND list_contains(words, 'of') AND list_contains(words, 'with')")
def lexical_and_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").where(recall.has_all(F.col("text"), recall.query_lexemes("The of, with"))).select("doc_id")


@_query(f"""
{_WORDS},
h AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w) WHERE word IN ('from', 'with')),
l AS (SELECT doc_id, pos, least(max(CASE WHEN word = 'from' THEN pos END) OVER o, max(CASE WHEN word = 'with' THEN pos END) OVER o) AS low, max(CASE WHEN word = 'from' THEN pos END) OVER o AS f, max(CASE WHEN word = 'with' THEN pos END) OVER o AS g FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
c AS (SELECT doc_id, low, min(pos) AS high FROM l WHERE f IS NOT NULL AND g IS NOT NULL GROUP BY doc_id, low),
n AS (SELECT c.doc_id, c.low, c.high, count(*) AS hits FROM c JOIN h ON h.doc_id = c.doc_id AND h.pos BETWEEN c.low AND c.high GROUP BY ALL),
s AS (SELECT doc_id, sum(0.1::DOUBLE / (1 + high - low + 1 - hits)) AS score FROM n GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score FROM s ORDER BY round(score, 6) DESC, doc_id LIMIT 50""")
def lexical_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = recall.query_lexemes("from with")
    rows = _read(spark, sf_dir, "documents").where(recall.has_all(F.col("text"), terms))
    return rows.select("doc_id", F.round(recall.cover_density(F.col("text"), terms), 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(50)


# Filters, joins, tables, reports.

_FACTS = "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"


@_query(f"SELECT doc_id FROM ({_FACTS}) WHERE lang IN ('en', 'es') AND source NOT IN ('src0', 'src1') AND least(1.0, n_chars / 4000.0) BETWEEN 0.1 AND 0.9 AND (quality = 1) AND (toxic = 1 OR lang = 'es')")
def advanced_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id")
    rows = rows.select(
        "doc_id",
        F.col("lang").alias("doc_type_category"),
        F.col("source").alias("institution"),
        F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("importance_score"),
        F.map_from_entries(F.array_compact(F.array(F.when(F.col("quality") == 1, F.struct(F.lit("GOOD"), F.lit(1)))))).alias("entities"),
        F.array_compact(F.array(F.when(F.col("toxic") == 1, "TOXIC"), F.when(F.col("lang") == "es", "ES"))).alias("tags"),
    )
    own = filters.AdvancedFilters.from_dict({"doc_types": ["en", "es"], "exclude_institutions": ["src0", "src1"], "min_importance": 0.1, "max_importance": 0.9, "entities": "GOOD", "tags": ["TOXIC", "ES"]})
    return rows.where(own.predicate()).select("doc_id")


@_query(f"{_BASE} SELECT doc_id FROM base WHERE {_count('t', ['und'])} > 0 OR {_count('t', ['la', 'de la'])} > 0 OR lang = 'fr'")
def any_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = Taxonomy(variables={n: STOP_WORDS.variables[n] for n in ("GERMAN", "SPANISH")})  # no other name is counted
    rows = _read(spark, sf_dir, "documents").withColumn("vars", enrich.variables(T.normalize_text(F.col("text")), asked))
    return rows.where(filters.any_key(F.col("vars"), ["GERMAN", "SPANISH"]) | (F.col("lang") == "fr")).select("doc_id")


@_query("SELECT o_orderkey FROM orders WHERE (year(o_orderdate) BETWEEN 1995 AND 1996) AND o_orderstatus IN ('O', 'P') AND month(o_orderdate) = 3")
def search_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("doc_type_category"), F.col("o_orderdate").cast("date").alias("chunk_date"), F.lit(None).cast("int").alias("document_year"), F.lit(None).cast("string").alias("document_date"), F.lit("").alias("filename"))
    where = filters.search_filter({"doc_types": ["O", "P"], "year_from": 1995, "year_to": 1996})
    return rows.where(where).where(filters.effective_month() == 3).select("o_orderkey")


@_query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE month(o_orderdate)::INTEGER END AS m FROM orders")
def effective_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    rows = _read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(None).cast("date").alias("chunk_date"),
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.lit("1999")).alias("document_date"),
        F.when(k == 1, F.date_format(d, "'x_'dd-MM-yy'.pdf'")).otherwise("plain.pdf").alias("filename"),
    )
    return rows.select("o_orderkey", filters.effective_month().alias("m"))


@_query("SELECT lang AS doc_type_category, count(*)::BIGINT AS chunks FROM documents d JOIN labels l USING (doc_id) GROUP BY lang")
def group_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.col("lang").alias("doc_type_category"))
    return stats.by_type(_read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "document_id"), docs)


@_query("SELECT source AS section_type, count(*) AS chunks FROM documents GROUP BY source")
def group_by_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_section(_read(spark, sf_dir, "documents").withColumnRenamed("source", "section_type"))


@_query(f"SELECT count(*) AS chunks, round(avg(i), 3) AS mean_importance, count(*) FILTER (i >= 0.6) AS high, (100 * count(*) FILTER (i >= 0.6)) // greatest(1, count(*)) AS high_percent, count(*) FILTER (toxic = 1) AS policy_decisions FROM (SELECT least(1.0::DOUBLE, n_chars / 4000.0::DOUBLE) AS i, toxic FROM ({_FACTS}))")
def avg_and_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id")
    return stats.importance_summary(rows.select(F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("importance_score"), (F.col("toxic") == 1).alias("is_policy_decision")))


@_query("SELECT min(n_chars) AS min, sum(n_chars)::BIGINT // count(*) AS mean, max(n_chars) AS max, count(*) FILTER (n_chars > 2048) AS truncated FROM documents")
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.token_summary(_read(spark, sf_dir, "documents"), "n_chars")


@_query("SELECT count(*) AS documents, sum(n)::BIGINT AS chunks, count(*) FILTER (n = 0) AS failed, count(*) FILTER (toxic = 1) AS with_warnings FROM (SELECT doc_id, toxic, quality::BIGINT AS n FROM labels)")
def extraction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "labels").select(F.col("quality").alias("total_chunks"), F.array_compact(F.array(F.when(F.col("toxic") == 1, "w"))).alias("extraction_warnings"), F.col("doc_id").cast("string").alias("filename"))
    return stats.extraction_report(rows)


@_query("SELECT doc_id, lang, CASE WHEN l_doc IS NULL THEN n_chars ELSE quality END AS n_chars FROM (SELECT d.*, l.doc_id AS l_doc, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    new = _read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("n_chars"), F.lit("?").alias("lang"))
    return store.upsert(old, new, "doc_id", keep=("lang",))


@_query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, toxic::BIGINT FROM labels")
def replace_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("n_chars"))
    return store.replace_chunks(_read(spark, sf_dir, "documents").select("doc_id", "n_chars"), new, "doc_id")


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"))
    return stats.orphans(docs, _read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "document_id")).select(F.col("document_id").alias("doc_id"))


@_query("SELECT vec_id FROM embeddings WHERE len(embedding) = 64")
def valid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.valid_chunks(_read(spark, sf_dir, "embeddings"), 64).select("vec_id")


_CITED = "row_number() OVER (ORDER BY n_chars DESC, doc_id)::INTEGER"


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(10)
    hits = rows.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("filename"), F.col("lang").alias("doc_type_category"), F.lit("CONTENIDO").alias("section_type"), F.lit(1).alias("page_start"), (F.lit(1) + F.col("doc_id") % 2).cast("int").alias("page_end"), F.lit("2020-01-02").alias("document_date"), F.lit(0.5).alias("importance_score"), "text", "n_chars")
    return prompt.numbered(hits, [F.desc("n_chars"), F.col("chunk_id")])


@_query(f"SELECT {_CITED} AS citation_number, source AS filename, lang AS doc_type, (1 + doc_id % 2)::INTEGER AS page_end, doc_id AS chunk_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt.citations(_cited(spark, sf_dir)).select("citation_number", "filename", "doc_type", "page_end", "chunk_id")


@_query(f"SELECT n AS citation_number, '[' || n || '] ' || source || CASE WHEN doc_id % 2 = 0 THEN ' p.1' ELSE ' pp.1-2' END || ' · ' || lang || ' · CONTENIDO · 2020-01-02' || chr(10) || '    ' || trim(replace(text, chr(10), ' ')) AS fragment FROM (SELECT *, {_CITED} AS n FROM documents ORDER BY n LIMIT 10)")
def context_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt.fragments(_cited(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corvane.plans import more, stored  # noqa: F401  add their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from corvane.plans import more, stored  # noqa: F401

    return dict(SQL)
