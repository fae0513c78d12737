"""The jobs as queries: each runs twice into one new folder, and its whole output is read back; and SQL for it."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.recall import query_lexemes
from corvane.plans.catalog import _FOLD, _count, _normal
from jobs import chunk_stream, watchlist


def _folder(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share; its files stay."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(shared or 'file://' + tempfile.gettempdir()).rstrip('/')}/corvane-jobs-{uuid.uuid4().hex}"


def _config(name: str) -> dict:
    return json.loads((Path(__file__).parent / f"{name}.json").read_text())


CHUNKS, WATCHLIST = _config("chunk_stream"), _config("watchlist")


def job1_chunk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a file stream to enriched chunks; the second run finds nothing new. A row for each chunk, and for each document without any."""
    folder = _folder(spark)
    for _ in range(2):
        chunk_stream.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/chunks", f"{folder}/checkpoint", taxonomy=chunk_stream.taxonomy_of(CHUNKS["taxonomy"]), chunks=CHUNKS["chunks"], numbers=chunk_stream.numbers_of(CHUNKS["numbers"]), files_per_batch=CHUNKS["files_per_batch"])
    chunks, documents = chunk_stream.current(spark, f"{folder}/chunks")
    rows = documents.join(chunks.drop("batch", "lang"), "doc_id", "left")
    return rows.select("doc_id", "lang", "source", "n_chunks", "chunk_id", "position", "text", "section_type", "importance_score", F.array_join("tags", ",").alias("tags"), F.array_join("variables", ",").alias("variables"))


def _chunk_sql() -> str:
    """Chunks by a recursive fold, their enrichment by counted words; from the job's configuration."""
    tax = CHUNKS["taxonomy"]
    variables, sections, entities = tax["variables"], tax["sections"], tax["entities"]
    counts = [f"{_count('t', w)} AS s_{n}" for n, w in sections.items()] + [f"{_count('t', w)} AS v_{n}" for n, (_, w) in variables.items()] + [f"{_count('t', w)} AS e_{n}" for n, w in entities.items()]
    best = f"greatest({', '.join('s_' + n for n in sections)})"
    found = lambda level: " OR ".join(f"v_{n} > 0" for n, (own, _) in variables.items() if own == level)
    critical = " + ".join(f"(v_{n} > 0)::INT" for n, (own, _) in variables.items() if own == "CRITICAL")
    place = "CASE WHEN place < 0.05 THEN 'ENCABEZADO' WHEN place < 0.20 THEN 'CONTEXTO_EXTERNO' WHEN place < 0.35 THEN 'ANALISIS' WHEN place > 0.85 THEN 'RIESGOS' WHEN place > 0.70 THEN 'PROYECCION' ELSE 'CONTENIDO' END"
    section = "CASE " + " ".join(f"WHEN s_{n} > 0 AND s_{n} = {best} THEN '{n}'" for n in sections) + f" ELSE {place} END"
    return rf"""{_FOLD},
ch AS (SELECT doc_id, unnest(c) AS text, unnest(range(len(c)))::INTEGER AS position, len(c) AS total FROM m),
base AS (SELECT *, {_normal()} AS t, position / greatest(1, total - 1)::DOUBLE AS place FROM ch),
cnt AS (SELECT *, least(10, len(list_distinct(regexp_extract_all(text, '(\d{{1,4}})', 1)))) AS nums, {_count("t", tax["forward"])} > 0 AS fwd, {_count("t", tax["boilerplate"])} > 0 AS boiler, {", ".join(counts)} FROM base),
sec AS (SELECT *, {section} AS section_type, {critical} AS critical FROM cnt),
e AS (SELECT doc_id, position, text, section_type, CASE WHEN boiler THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
  CASE WHEN critical >= 2 THEN 0.35::DOUBLE + 0.10::DOUBLE WHEN critical = 1 THEN 0.35::DOUBLE WHEN {found("HIGH")} THEN 0.20::DOUBLE WHEN {found("MEDIUM")} THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + 0.20::DOUBLE * least(1.0::DOUBLE, nums / 3.0::DOUBLE)
  + CASE WHEN section_type = 'DECISION' THEN 0.25::DOUBLE WHEN section_type IN ('PROYECCION', 'RIESGOS') THEN 0.15::DOUBLE WHEN section_type = 'ANALISIS' THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN fwd THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
  + 0.10::DOUBLE * least(1.0::DOUBLE, ({" + ".join(f"(e_{n} > 0)::INT" for n in entities)}) / 2.0::DOUBLE)
  - CASE WHEN NOT ({" OR ".join(f"v_{n} > 0" for n in variables)}) AND nums = 0 THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END)), 3) END AS importance_score,
  array_to_string(list_filter([CASE WHEN section_type = 'DECISION' THEN 'DECISION_POLITICA' END, CASE WHEN fwd THEN 'FORWARD_LOOKING' END, CASE WHEN nums > 0 THEN 'DATOS_NUMERICOS' END, CASE WHEN critical > 0 THEN 'VARIABLE_CRITICA' END], lambda x: x IS NOT NULL), ',') AS tags,
  array_to_string(list_filter([{", ".join(f"CASE WHEN v_{n} > 0 THEN '{n}' END" for n in variables)}], lambda x: x IS NOT NULL), ',') AS variables FROM sec)
SELECT d.doc_id, coalesce(d.lang, 'und') AS lang, d.source, coalesce(len(m.c), 0)::BIGINT AS n_chunks, printf('%d_%04d', d.doc_id, e.position) AS chunk_id, e.position, e.text, e.section_type, e.importance_score, e.tags, e.variables
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id LEFT JOIN e ON d.doc_id = e.doc_id WHERE d.doc_id IS NOT NULL"""


def job2_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved queries over documents and embeddings; the second run replaces the first one's partitions by the same rows."""
    folder = _folder(spark)
    for _ in range(2):
        watchlist.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/embeddings.parquet", f"{folder}/hits", queries=WATCHLIST["queries"], recall=WATCHLIST["recall"], hits=WATCHLIST["hits"])
    return watchlist.read(spark, f"{folder}/hits")


def _lexical_sql(terms: list[str], langs: list[str] | None, n: int) -> str:
    """Ranks by cover density of any number of terms: a cover ends where the least of the terms' last places moves."""
    last = ", ".join(f"max(CASE WHEN word = '{t}' THEN pos END) OVER o AS p{i}" for i, t in enumerate(terms))
    there = " AND ".join(f"p{i} IS NOT NULL" for i in range(len(terms)))
    low = f"least({', '.join(f'p{i}' for i in range(len(terms)))})" if len(terms) > 1 else "p0"
    limit = f"AND lang IN ({', '.join(repr(x) for x in langs)})" if langs else ""
    return f"""
SELECT doc_id, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank FROM (
  SELECT c.doc_id, sum(0.1::DOUBLE / (1 + c.high - c.low + 1 - c.hits)) AS score FROM (
    SELECT l.doc_id, l.low, l.high, count(*) AS hits FROM (SELECT doc_id, {low} AS low, min(pos) AS high FROM (SELECT doc_id, pos, {last} FROM tok WHERE word IN ({", ".join(repr(t) for t in terms)}) {limit} WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) WHERE {there} GROUP BY doc_id, {low}) l
    JOIN tok h ON h.doc_id = l.doc_id AND h.pos BETWEEN l.low AND l.high AND h.word IN ({", ".join(repr(t) for t in terms)}) GROUP BY ALL) c GROUP BY c.doc_id) QUALIFY rank <= {n}"""


def _watchlist_sql() -> str:
    """Two rankings of each saved query, fused; from the job's configuration."""
    n, hits, named, found = WATCHLIST["recall"], WATCHLIST["hits"], [], []
    empty = "SELECT NULL::BIGINT AS doc_id, NULL::BIGINT AS rank WHERE false"
    for i, q in enumerate(WATCHLIST["queries"]):
        langs = q.get("langs")
        limit = f"WHERE d.lang IN ({', '.join(repr(x) for x in langs)})" if langs else ""
        lexical = _lexical_sql(query_lexemes(q["words"]), langs, n) if q.get("words") else empty
        near = f"SELECT e.vec_id AS doc_id, row_number() OVER (ORDER BY round(list_cosine_similarity(e.embedding::DOUBLE[], x.embedding::DOUBLE[]), 12) DESC, e.vec_id) AS rank FROM embeddings e JOIN dl d ON d.doc_id = e.vec_id, (SELECT embedding FROM embeddings WHERE vec_id = {q['like']}) x {limit} QUALIFY rank <= {n}" if q.get("like") is not None else empty
        named += [f"a{i} AS ({lexical})", f"b{i} AS ({near})"]
        found.append(f"""
SELECT '{q["name"]}' AS query, f.* FROM (SELECT 1) LEFT JOIN (
  SELECT row_number() OVER (ORDER BY round(rrf, 9) DESC, coalesce(a_rank * 0, 1), coalesce(a_rank, b_rank)) AS rank, doc_id, rrf, a_rank, b_rank
  FROM (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.rank AS a_rank, b.rank AS b_rank, coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS rrf FROM a{i} a FULL JOIN b{i} b ON a.doc_id = b.doc_id)
  QUALIFY rank <= {hits}) f ON true""")
    return rf"""
WITH dl AS (SELECT doc_id, coalesce(lang, 'und') AS lang, source FROM documents),
tok AS (SELECT doc_id, lang, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM documents)),
{", ".join(named)},
r AS ({" UNION ALL ".join(found)})
SELECT r.query, r.rank::INTEGER AS rank, r.doc_id, round(r.rrf, 9) AS score, r.a_rank::INTEGER AS lexical_rank, r.b_rank::INTEGER AS vector_rank, dl.lang, dl.source FROM r LEFT JOIN dl ON dl.doc_id = r.doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_chunk_stream, job2_watchlist)}


def oracle_sql() -> dict[str, str]:
    return {"job1_chunk_stream": _chunk_sql(), "job2_watchlist": _watchlist_sql()}
