"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tools that calls are checked against.
TOOLS = {"measure": {"type": "object", "properties": {"length": {"type": "integer", "minimum": 0, "maximum": 400}}, "required": ["length"], "additionalProperties": False}}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.quality import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.jaccard import jaccard_classes

    return jaccard_classes(_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.linededup import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def line_dedup_few_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup as the pipeline's stage asks for it: a line on three sites is boilerplate."""
    from corvane.llm.linededup import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents"), min_sites=3).select("doc_id", "text", "n_lines", "n_removed")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.exactdedup import exact_dedup

    return exact_dedup(_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.piecescan import encoded_report

    return encoded_report(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.packing import packed_documents

    return packed_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.annforest import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.chat import format_chats

    return format_chats(_table(spark, sf_dir, "conversations"), TOOLS).withColumn("problems", F.array_join("problems", "; "))


def chat_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linking, order and validation over calls made of the conversations, which hold none themselves.

    An assistant's turn t becomes a call c<t> of the tool "measure" with the text's length; a user's turn t from 1 on
    becomes the result of call c<t-1>, put before it. Texts over 400 characters break the schema, and where
    turn t-1 isn't an assistant's the result has no call.
    """
    from corvane.llm.chat import format_chats

    turns = _table(spark, sf_dir, "conversations")
    call = F.concat(F.lit('<tool_call>{"id":"c'), F.col("turn"), F.lit('","name":"measure","arguments":{"length":'), F.char_length("text"), F.lit("}}</tool_call>"))
    result = F.to_json(F.struct(F.concat(F.lit("c"), F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    answers = (F.col("role") == "user") & (F.col("turn") > 0)
    made = turns.select(
        "conv_id",
        F.when(answers, F.col("turn") - 2).otherwise(F.col("turn")).alias("turn"),
        F.when(answers, "tool").otherwise(F.col("role")).alias("role"),
        F.when(answers, result).when(F.col("role") == "assistant", call).otherwise(F.col("text")).alias("text"),
    )
    return format_chats(made, TOOLS).withColumn("problems", F.array_join(F.array_sort("problems"), "; "))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.lm import train_and_score

    return train_and_score(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.tokenbin import token_files

    return token_files(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2).drop("shard")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.collocations import collocations

    return collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.substrings import substring_dedup

    kept = substring_dedup(_table(spark, sf_dir, "documents"), width=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_quality, op2_jaccard, op3_line_dedup, op4_exact_dedup, op5_sentencepiece, op6_packing, op7_nearest, op8_chat, op9_lm_score, op10_token_files, op11_collocations, op12_substring_dedup, chat_tool_links, line_dedup_few_sites, pipeline)
    return {f.__name__: f for f in every}


_TRIM = r"regexp_replace(line, '^[ \t\r\x0B\f]+|[ \t\r\x0B\f]+$', '', 'g')"

#: A line on ten or more sites stays only where it first occurs, by id and position.
OP3_SQL = rf"""
WITH split AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, source, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
keyed AS (SELECT doc_id, source, line, pos, {_TRIM} AS k FROM lines),
common AS (SELECT k, min(struct_pack(d := doc_id, p := pos)) AS first FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10),
marked AS (SELECT l.doc_id, l.pos, l.line, c.k IS NOT NULL AND NOT (c.first.d = l.doc_id AND c.first.p = l.pos) AS gone FROM keyed l LEFT JOIN common c ON l.k = c.k),
kept AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM marked GROUP BY doc_id)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0)::INTEGER AS n_lines, coalesce(k.n_removed, 0)::INTEGER AS n_removed FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

LINE_DEDUP_FEW_SITES_SQL = OP3_SQL.replace("count(DISTINCT source) >= 10", "count(DISTINCT source) >= 3")

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""

#: The tables have no tool calls; chat_tool_links makes some of them.
OP8_SQL = """
SELECT conv_id, count(*) AS n_turns, 0::BIGINT AS n_calls, 0::BIGINT AS n_linked, '' AS problems,
       '[' || string_agg('{"content":' || to_json(coalesce(text, ''))::VARCHAR || ',"role":' || to_json(coalesce(role, ''))::VARCHAR || '}', ',' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) || ']' AS text
FROM conversations GROUP BY conv_id
"""

CHAT_TOOL_LINKS_SQL = """
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, role = 'user' AND turn > 0 AS answers FROM conversations),
linked AS (SELECT a.*, coalesce(a.answers AND c.conv_id IS NOT NULL, false) AS has_call
           FROM t a LEFT JOIN (SELECT DISTINCT conv_id, turn FROM t WHERE role = 'assistant') c ON a.conv_id = c.conv_id AND a.turn = c.turn + 1),
message AS (SELECT *, CASE WHEN answers AND NOT has_call THEN turn - 2 ELSE turn END AS place,
  CASE WHEN has_call THEN '{"content":' || to_json(text)::VARCHAR || ',"name":"measure","role":"tool","tool_call_id":"c' || (turn - 1) || '"}'
       WHEN answers THEN '{"content":' || to_json(text)::VARCHAR || ',"role":"tool","tool_call_id":"c' || (turn - 1) || '"}'
       WHEN role = 'assistant' THEN '{"content":"","role":"assistant","tool_calls":[{"arguments":{"length":' || length(text) || '},"id":"c' || turn || '","name":"measure"}]}'
       ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(coalesce(role, ''))::VARCHAR || '}' END AS json,
  CASE WHEN answers AND NOT has_call THEN 'c' || (turn - 1) || ': result without a call'
       WHEN role = 'assistant' AND length(text) > 400 THEN 'c' || turn || ': $.length: over the maximum' END AS problem FROM linked)
SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = 'assistant') AS n_calls, count(*) FILTER (has_call) AS n_linked,
       coalesce(string_agg(problem, '; ' ORDER BY problem), '') AS problems, '[' || string_agg(json, ',' ORDER BY place) || ']' AS text
FROM message GROUP BY conv_id
"""

#: Phrases as lists of words; sub-phrases of frequent phrases are frequent, so f holds all that cuts need.
OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
q AS (SELECT lang, row_number() OVER () AS id, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
w AS (SELECT lang, id, unnest(ws) AS w1, unnest(range(len(ws))) AS pos FROM q),
g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5 FROM w WINDOW o AS (PARTITION BY id ORDER BY pos)),
t AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
s AS (SELECT lang, 1 AS m, w1 AS phrase FROM g UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM g UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM g
      UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM g UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM g),
f AS (SELECT lang, string_split(phrase, ' ') AS ws, m, count(*) AS f FROM s WHERE phrase IS NOT NULL GROUP BY lang, phrase, m HAVING count(*) >= 100),
cut AS (SELECT c.lang, c.ws, c.f AS a, k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
        FROM f c, range(1, 5) AS x(k), f l, f r, t WHERE c.m > k AND l.lang = c.lang AND l.ws = c.ws[1:k] AND r.lang = c.lang AND r.ws = c.ws[k + 1 : c.m] AND t.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
part AS (SELECT lang, ws[i : i + s - 1] AS ws, max(f) AS longer FROM f, range(2, 5) AS x(s), range(1, 5) AS y(i) WHERE s < m AND i + s - 1 <= m GROUP BY ALL),
ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, array_to_string(b.ws, ' ')) AS rank, array_to_string(b.ws, ' ') AS phrase, a, l, r, n, b.score::BIGINT AS score
           FROM best b LEFT JOIN part ON b.lang = part.lang AND b.ws = part.ws WHERE part.longer IS NULL OR 100 * part.longer < 100 * b.a)
SELECT * FROM ranked WHERE rank <= 2000
"""

#: Windows of 20 words as strings; a word is covered if one of the 20 windows up to it repeats an earlier one.
OP12_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d),
s AS (SELECT doc_id, pos, string_agg(word, ' ') OVER win AS phrase, count(*) OVER win AS n FROM w WINDOW win AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
k AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, pos) > 1 AS again FROM s WHERE n = 20),
c AS (SELECT w.doc_id, w.pos, w.word, coalesce(bool_or(k.again) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
      FROM w LEFT JOIN k ON w.doc_id = k.doc_id AND w.pos = k.pos),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"chat_tool_links": CHAT_TOOL_LINKS_SQL, "line_dedup_few_sites": LINE_DEDUP_FEW_SITES_SQL, "op3_line_dedup": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op11_collocations": OP11_SQL, "op12_substring_dedup": OP12_SQL, "op8_chat": OP8_SQL}
