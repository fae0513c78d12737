"""Chunk enrichment: variables, entities, section, numbers, references, tags and importance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import keywords
from corvane.functions import text as T
from corvane.functions.taxonomy import DOMAIN, Taxonomy

# The weights of the importance score and the bands of positions.
WEIGHTS = {
    "critical_var": 0.35,
    "many_critical": 0.10,
    "high_var_only": 0.20,
    "medium_var_only": 0.08,
    "numerics": 0.20,
    "policy_section": 0.25,
    "outlook_section": 0.15,
    "analysis_section": 0.08,
    "monitor_pm_section": 0.12,
    "forward_looking": 0.08,
    "entities": 0.10,
    "no_variables_penalty": 0.12,
}
DEFAULT_TYPE, DEFAULT_INSTITUTION = "REPORTE_RESEARCH", "unknown"


def lists(taxonomy: Taxonomy) -> list[list[str]]:
    """All keyword lists of a taxonomy, in the order that the functions here look for their counts: variables, entities, sections, forward, boilerplate."""
    return [*[w for _, w in taxonomy.variables.values()], *taxonomy.entities.values(), *taxonomy.sections.values(), taxonomy.forward, taxonomy.boilerplate]


def keyword_counts(normal: Column, taxonomy: Taxonomy) -> Column:
    """array<int>: the counts of all lists(), in one pass; the functions below take it as `counts` instead of looking through the text themselves."""
    return keywords.counts(normal, lists(taxonomy))


def _mentions(normal: Column, named: list[list[str]], counts: Column | None, at: int) -> list[Column]:
    """Counts of lists, of which the first stands at `at` among all."""
    return [T.mentions(normal, words) for words in named] if counts is None else [F.get(counts, at + i) for i in range(len(named))]


def _any(normal: Column, words: list[str], counts: Column | None, taxonomy: Taxonomy, from_end: int) -> Column:
    return normal.rlike(T.word_pattern(words)) if counts is None else F.get(counts, len(lists(taxonomy)) - from_end) > 0


def forward(normal: Column, taxonomy: Taxonomy, counts: Column | None = None) -> Column:
    """Whether a phrase about the future occurs."""
    return _any(normal, taxonomy.forward, counts, taxonomy, 2)


def variables(normal: Column, taxonomy: Taxonomy, counts: Column | None = None) -> Column:
    """map<name, struct<importance, mentions, confidence>> of the variables that occur, in the taxonomy's order."""
    if not taxonomy.variables:
        return F.create_map().cast("map<string,struct<importance:string,mentions:int,confidence:double>>")
    names, levels = (F.array(*map(F.lit, x)) for x in (list(taxonomy.variables), [level for level, _ in taxonomy.variables.values()]))
    found = F.array(*_mentions(normal, [w for _, w in taxonomy.variables.values()], counts, 0))

    def entry(n: Column, i: Column) -> Column:
        confidence = F.round(F.least(F.lit(1.0), 0.5 + 0.1 * (n - 1)), 2)
        return F.struct(F.get(names, i).alias("key"), F.struct(F.get(levels, i).alias("importance"), n.alias("mentions"), confidence.alias("confidence")).alias("value"))

    return F.map_from_entries(F.filter(F.transform(found, entry), lambda e: e["value"]["mentions"] > 0))


def entities(normal: Column, taxonomy: Taxonomy, counts: Column | None = None) -> Column:
    """map<name, count> of the entities that occur."""
    if not taxonomy.entities:
        return F.create_map().cast("map<string,int>")
    found = _mentions(normal, list(taxonomy.entities.values()), counts, len(taxonomy.variables))
    every = F.array(*[F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in zip(taxonomy.entities, found)])
    return F.map_from_entries(F.filter(every, lambda e: e["value"] > 0))


def section(normal: Column, position: Column, total: Column, hint: Column, taxonomy: Taxonomy, counts: Column | None = None) -> Column:
    """struct<type, confidence>: by title, else by most keyword matches (first in order on a tie), else by place in the document."""
    out = lambda t, c: F.struct((t if isinstance(t, Column) else F.lit(t)).alias("type"), (c if isinstance(c, Column) else F.lit(c)).alias("confidence"))
    title = T.normalize_text(F.coalesce(hint, F.lit("")))
    unnamed = named = F.lit(None).cast("string")
    for name in reversed(taxonomy.sections):
        named = F.when(title.contains(name.lower()), name).otherwise(named)
    # Most chunks have no title, in which there is no name to look for.
    named = named if "" in taxonomy.sections else F.when(F.coalesce(hint, F.lit("")) == "", unnamed).otherwise(named)
    found = _mentions(normal, list(taxonomy.sections.values()), counts, len(taxonomy.variables) + len(taxonomy.entities))
    scores = F.array(*[F.struct(c.alias("score"), F.lit(-i).alias("order"), F.lit(n).alias("name")) for i, (n, c) in enumerate(zip(taxonomy.sections, found))])
    scores = scores if taxonomy.sections else scores.cast("array<struct<score:int,order:int,name:string>>")
    place = position / F.greatest(F.lit(1), total - 1)
    by_place = (
        F.when(total <= 0, out("CONTENIDO", 0.25))
        .when(place < 0.05, out("ENCABEZADO", 0.40))
        .when(place < 0.20, out("CONTEXTO_EXTERNO", 0.30))
        .when(place < 0.35, out("ANALISIS", 0.28))
        .when(place > 0.85, out("RIESGOS", 0.28))
        .when(place > 0.70, out("PROYECCION", 0.30))
        .otherwise(out("CONTENIDO", 0.25))
    )

    def by_score(s: Column) -> Column:
        best = F.array_max(s)
        every = F.aggregate(s, F.lit(0), lambda a, x: a + x["score"])
        return F.when(best["score"] > 0, out(best["name"], F.round(F.least(F.lit(1.0), 0.40 + best["score"] / (every + 1)), 2)))

    return F.when(named.isNotNull(), out(named, 0.95)).otherwise(F.coalesce(T.let(scores, by_score), by_place))


def tags(normal: Column, own_variables: Column, numbers: Column, section_type: Column, taxonomy: Taxonomy, counts: Column | None = None) -> Column:
    critical = F.array(*map(F.lit, taxonomy.names("CRITICAL"))) if taxonomy.names("CRITICAL") else F.array().cast("array<string>")
    return F.array_compact(
        F.array(
            F.when(section_type == "DECISION", "DECISION_POLITICA"),
            F.when(section_type == "VOTACION", "VOTACION"),
            F.when(forward(normal, taxonomy, counts), "FORWARD_LOOKING"),
            F.when(F.size(numbers) > 0, "DATOS_NUMERICOS"),
            F.when(F.arrays_overlap(F.map_keys(own_variables), critical), "VARIABLE_CRITICA"),
        )
    )


def importance(normal: Column, own_variables: Column, numbers: Column, section_type: Column, own_entities: Column, forward: Column, taxonomy: Taxonomy, weights: dict[str, float] = WEIGHTS, counts: Column | None = None) -> Column:
    """A score from 0 to 1 with three decimals; boilerplate scores 0. Terms are added in this order."""
    w = {k: F.lit(v) for k, v in weights.items()}
    zero = F.lit(0.0)
    levels = F.transform(F.map_values(own_variables), lambda v: v["importance"])
    critical = F.size(F.filter(levels, lambda x: x == "CRITICAL"))
    score = F.when(critical >= 2, zero + w["critical_var"] + w["many_critical"]).when(critical == 1, zero + w["critical_var"]).when(F.array_contains(levels, "HIGH"), zero + w["high_var_only"]).when(F.array_contains(levels, "MEDIUM"), zero + w["medium_var_only"]).otherwise(zero)
    score = score + w["numerics"] * F.least(F.lit(1.0), F.size(numbers) / 3)
    monitor = sorted(set(taxonomy.monitor_sections.values()))
    score = score + (
        F.when(section_type.isin("DECISION", "VOTACION"), w["policy_section"])
        .when(section_type.isin("PROYECCION", "RIESGOS"), w["outlook_section"])
        .when(section_type == "ANALISIS", w["analysis_section"])
        .when(section_type.isin(*monitor) if monitor else F.lit(False), w["monitor_pm_section"])
        .otherwise(zero)
    )
    score = score + F.when(forward, w["forward_looking"]).otherwise(zero)
    score = score + w["entities"] * F.least(F.lit(1.0), F.size(own_entities) / 2)
    score = score - F.when((F.size(own_variables) == 0) & (F.size(numbers) == 0), w["no_variables_penalty"]).otherwise(zero)
    return F.when(_any(normal, taxonomy.boilerplate, counts, taxonomy, 1), zero).otherwise(F.round(F.greatest(zero, F.least(F.lit(1.0), score)), 3))


def enrich_chunks(chunks: DataFrame, documents: DataFrame, taxonomy: Taxonomy = DOMAIN) -> DataFrame:
    """Chunks with all metadata. A chunk without its document gets the default type and institution.

    Documents are one row each and join by a shuffle or broadcast as their size
    allows. total_in_doc, which chunking gives, is only counted where it is missing.
    """
    docs = documents.select("document_id", "doc_type_category", "institution", "document_date")
    if "total_in_doc" not in chunks.columns:
        chunks = chunks.withColumn("total_in_doc", F.count("*").over(Window.partitionBy("document_id")))
    rows = chunks.join(docs, "document_id", "left")
    rows = rows.withColumn("doc_type_category", F.coalesce("doc_type_category", F.lit(DEFAULT_TYPE))).withColumn("institution", F.coalesce("institution", F.lit(DEFAULT_INSTITUTION)))
    rows = rows.withColumn("normal", T.normalize_text(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("counts", keyword_counts(F.col("normal"), taxonomy))
    own = F.col("counts")
    rows = rows.withColumns({"economic_variables": variables(F.col("normal"), taxonomy, own), "entities": entities(F.col("normal"), taxonomy, own), "numeric_values": T.numeric_values(F.coalesce("text", F.lit(""))), "temporal_refs": T.temporal_refs(F.coalesce("text", F.lit("")))})
    found = section(F.col("normal"), F.col("position_in_doc"), F.col("total_in_doc"), F.col("section_title_raw"), taxonomy, own)
    if taxonomy.monitor_sections:
        titles = F.create_map(*[F.lit(x) for pair in taxonomy.monitor_sections.items() for x in pair])
        known = F.element_at(titles, F.coalesce("section_title_raw", F.lit("")))
        found = F.when((F.col("doc_type_category") == "MONITOR_PM") & known.isNotNull(), F.struct(known.alias("type"), F.lit(1.0).alias("confidence"))).otherwise(found)
    rows = rows.withColumn("found", found).withColumns({"section_type": F.col("found.type"), "section_confidence": F.col("found.confidence"), "is_forward_looking": forward(F.col("normal"), taxonomy, own)})
    rows = rows.withColumns({
        "tags": tags(F.col("normal"), F.col("economic_variables"), F.col("numeric_values"), F.col("section_type"), taxonomy, own),
        "importance_score": importance(F.col("normal"), F.col("economic_variables"), F.col("numeric_values"), F.col("section_type"), F.col("entities"), F.col("is_forward_looking"), taxonomy, counts=own),
        "is_policy_decision": F.col("section_type").isin("DECISION", "VOTACION"),
    })
    if "chunk_date" not in rows.columns:
        rows = rows.withColumn("chunk_date", F.lit(None).cast("date"))
    rows = rows.withColumn("chunk_date", F.try_to_date(F.substring(F.col("chunk_date").cast("string"), 1, 10), "yyyy-MM-dd"))
    return rows.drop("normal", "counts", "found", "total_in_doc", "section_title_raw", "token_estimate")


def embed_text(chunks: DataFrame, model: str, taxonomy: Taxonomy = DOMAIN, *, context: bool = True) -> DataFrame:
    """chunks with embed_text: "[TYPE | SECTION | up to three variables] text", and the passage prefix that E5 models want."""
    level = F.create_map(F.lit("CRITICAL"), F.lit(0), F.lit("HIGH"), F.lit(1), F.lit("MEDIUM"), F.lit(2))
    order = F.array(*[F.lit(n) for n in taxonomy.variables]) if taxonomy.variables else F.array().cast("array<string>")
    ranked = F.array_sort(F.transform(F.map_entries("economic_variables"), lambda e: F.struct(F.coalesce(F.element_at(level, e["value"]["importance"]), F.lit(3)).alias("level"), F.array_position(order, e["key"]).alias("at"), e["key"].alias("name"))))
    names = F.array_join(F.transform(F.slice(ranked, 1, 3), lambda x: x["name"]), ", ")
    parts = F.filter(F.array(F.coalesce("doc_type_category", F.lit("")), F.coalesce("section_type", F.lit("")), F.coalesce(names, F.lit(""))), lambda p: p != "")
    out = F.concat(F.lit("["), F.array_join(parts, " | "), F.lit("] "), F.col("text")) if context else F.col("text")
    return chunks.withColumn("embed_text", F.concat(F.lit("passage: "), out) if "e5" in model.lower() else out)
