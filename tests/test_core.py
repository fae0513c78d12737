"""Functions, operators, store and search on small hand-made cases."""

import datetime
import re

import numpy as np
import pytest
from corvane.functions import taxonomy as X
from corvane.functions import text as T
from corvane.functions import vectors as V
from corvane.operators import chunking, embed, enrich, filters, fuse, index, recall, stats
from corvane import cli
from corvane.plans import catalog, parse, prompt, search
from corvane.plans.profiles import BASIC
from corvane.sources import files, store
from corvane.streaming import ingest
from pyspark.sql import functions as F


#: Some keywords: the library ships none for variables.
OWN = X.DOMAIN.with_keywords({"TASA_INTERES": ["tasa de interes", "tpm", "interest rate"], "INFLACION": ["inflacion", "ipc"], "EMPLEO": ["empleo"], "PRECIO_COMMODITIES": ["cobre", "petroleo"]})


def column(spark, make, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalising(spark):
    some = ["Ñandú  ÁÉ\tÇa", "ß œ Ő", "", "café"]
    assert column(spark, T.normalize_text, *some) == [T.normalized(s) for s in some] == ["nandu ae ca", "ß œ o", "", "cafe"]


def test_pages(spark):
    def plain(text):
        text = re.sub(r"-\n(\w)", r"\1", text)
        text = re.sub(r"(?<!\n)\n(?!\n)", " ", text)
        text = re.sub(r"[ \t]+", " ", text)
        text = re.sub(r"^\s*\d{1,3}\s*$", "", text, flags=re.MULTILINE)
        return re.sub(r"\{\[\{[^}]*\}\]\}", "", text).strip()

    some = ["inflació-\nñn sube\nya\n\n12\n\notro {[{ab12}]} fin", "7", "a\n\n\nb \t c", " 123 \n\n x", "1234\n\n5"]
    assert column(spark, T.normalize_page, *some) == [plain(s) for s in some]


def test_whole_words(spark):
    counts = column(spark, lambda x: T.mentions(x, ["tasa de interes", "tasa", "s&p 500", "ee.uu."]), "la tasa de interes y tasa", "tasador", "s&p 500 s&p 500", "ee.uu. eexuux", "")
    assert counts == [2, 0, 2, 1, 0]


@pytest.mark.parametrize(
    ("path", "kind", "who", "date", "strict"),
    [
        ("Comunicados\\Comunicado_31-01-24.pdf", "COMUNICADO", "banco_central_chile", "2024-01-31", None),
        ("Fed\\fed_press_jan25.pdf", "FED_STATEMENT", "federal_reserve", None, None),
        ("Researchs\\JPM\\2024.12.06 Outlook.pdf", "REPORTE_RESEARCH", "jpmorgan", "2024-12-06", "2024-12-06"),
        ("Minutas/Minuta_17-01-13.pdf", "MINUTA", "banco_central_chile", "2013-01-17", None),
        ("x/Monitor PM/textos.xlsx", "MONITOR_PM", "banco_central_chile", None, None),
        ("a/13 de Julio de 2022.pdf", "REPORTE_RESEARCH", "unknown", "2022-07-13", "2022-07-13"),
        ("a/report 1999 x.pdf", "REPORTE_RESEARCH", "unknown", "1999", "1999"),
        ("a/x_05-06-87.pdf", "REPORTE_RESEARCH", "unknown", "1987-06-05", None),
    ],
)
def test_description_from_paths(spark, path, kind, who, date, strict):
    name = re.split(r"[\\/]", path)[-1]
    r = spark.range(1).select(T.document_type(F.lit(path)), T.institution(F.lit(path)), T.detect_date(F.lit(name), F.lit("")), T.detect_date(F.lit(name), F.lit(""), short_years=False)).first()
    assert tuple(r) == (kind, who, date, strict)


def test_slugs(spark):
    assert column(spark, T.slug, "A b\\C-d.e.PDF", "x/y_z", ".hidden") == ["a_b_c_d_e", "x_y_z", "hidden"]


def test_titles_and_sentences(spark):
    assert column(spark, T.section_title, "DECISIÓN", "ANTECEDENTES Y ACUERDOS ", "AB", "Decision", "A" * 90, "AB\nCD EF") == ["DECISIÓN", "ANTECEDENTES Y ACUERDOS", None, None, None, None]
    assert column(spark, T.sentences, "Uno. Dos! tres? 4 cinco.") == [["Uno.", "Dos! tres?", "4 cinco."]]


def test_numbers(spark):
    got = column(spark, T.numeric_values, "sube 5,25% y 5,25 % a 75 pb; 3 millones, USD 1.200 y 1234%")[0]
    assert [(r["value"], r["unit"]) for r in got] == [("5,25", "percentage"), ("234", "percentage"), ("75", "basis_points"), ("3", "millions"), ("1.200", "usd_amount")]
    assert got[0]["raw"] == "5,25%"
    assert column(spark, T.temporal_refs, "Q1 2022, 1985 y 2022; 1979; 2.º trimestre", "x") == [(["1985", "2022"], ["Q1"]), (None, None)]


def fold(units, target=600, least=200, overlap=100):
    """Plain chunk packing."""
    chunks, buffer, pages, section, size = [], [], [], None, 0

    def flush():
        if buffer and " ".join(buffer).strip():
            chunks.append([" ".join(buffer).strip(), min(pages), max(pages), section])

    for text, page, own in units:
        if size + len(text) > target and size >= least:
            flush()
            tail = " ".join(buffer)[-overlap:]
            buffer, pages, size, section = [tail], [pages[-1]], len(tail), own or section
        buffer.append(text)
        pages.append(page)
        size += len(text) + 1
        section = section if section is not None else own
    flush()
    if len(chunks) >= 2 and len(chunks[-1][0]) < least:
        last = chunks.pop()
        chunks[-1][0] += " " + last[0]
        chunks[-1][2] = max(chunks[-1][2], last[2])
    return chunks


def test_chunks_with_pages_and_sections(spark):
    r = np.random.default_rng(4)
    words = ["uno", "dos", "tres", "cuatro", "cinco", "seis"]
    docs, want = [], []
    for d in range(12):
        pages, units, section = [], [], None
        for n in range(int(r.integers(0, 4))):
            paragraphs = []
            for _ in range(int(r.integers(1, 7))):
                if r.random() < 0.25:
                    section = ["DECISIÓN FINAL", "RIESGOS"][int(r.integers(2))]
                    paragraphs.append(section)
                    continue
                text = ". ".join(" ".join(r.choice(words, int(r.integers(3, 40)))).capitalize() for _ in range(int(r.integers(1, 9)))) + "."
                paragraphs.append(text)
                units += [(s, n + 1, section) for s in (re.split(r"(?<=[.!?])\s+(?=[A-Z])", text) if len(text) > 1200 else [text])]
            pages.append("\n\n".join(paragraphs))
        docs.append((f"d{d}", pages))
        want += [(f"d{d}", *c) for c in fold(units)]
    got = chunking.chunk_documents(spark.createDataFrame(docs, "document_id string, pages array<string>")).orderBy("document_id", "position_in_doc").collect()
    assert sorted((g["document_id"], g["text"], g["page_start"], g["page_end"], g["section_title_raw"]) for g in got) == sorted(want)
    assert all(g["chunk_id"] == f"{g['document_id']}_{g['position_in_doc']:04d}" for g in got)


def test_production_chunks_match_plain_code(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        page = re.sub(r"-\n(\w)", r"\1", r["text"] or "")
        page = re.sub(r"[ \t]+", " ", re.sub(r"(?<!\n)\n(?!\n)", " ", page))
        page = re.sub(r"\{\[\{[^}]*\}\]\}", "", re.sub(r"^\s*\d{1,3}\s*$", "", page, flags=re.MULTILINE)).strip()
        units, section = [], None
        for p in filter(None, (x.strip() for x in re.split(r"\n\s*\n+", page))):
            title = re.match(r"^([A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ\s]{2,60})\s*$", p) if len(p) <= 80 and "\n" not in p else None
            if title:
                section = title[1].strip()
                continue
            parts = filter(None, (x.strip() for x in re.split(T.SENTENCE_BREAK, p))) if len(p) > 1200 else [p]
            units += [(x, 1, section) for x in parts]
        own = fold(units)
        want += [(r["doc_id"], k, c[0], c[3], len(own)) for k, c in enumerate(own)]
    assert sorted(map(str, map(tuple, catalog.queries()["production_chunks"](spark, sf).collect()))) == sorted(map(str, want))


def test_chunks_of_nothing(spark):
    assert chunking.chunk_documents(spark.createDataFrame([("a", None), ("b", []), ("c", ["", None])], "document_id string, pages array<string>")).count() == 0


def test_cells(spark):
    wide = spark.createDataFrame([(datetime.date(2023, 11, 14), "texto bastante largo", "corto"), (None, "texto sin fecha alguna", None)], "Fecha date, `Renta Fija` string, Otro string")
    assert [tuple(r) for r in chunking.sheet_cells(wide).collect()] == [("2023-11-14", "Renta Fija", "texto bastante largo")]
    rows = spark.createDataFrame([(0, ["", None]), (1, ["a", ""]), (2, ["Fecha", "Texto"]), (3, ["x", "y"])], "row int, cells array<string>")
    assert tuple(chunking.header_row(rows).first()) == (2, ["Fecha", "Texto"])


def _rich(spark, texts, kind="MINUTA", titles=None):
    chunks = spark.createDataFrame([(f"d_{i:04d}", "d", t, len(t), i, (titles or {}).get(i)) for i, t in enumerate(texts)], "chunk_id string, document_id string, text string, char_count int, position_in_doc int, section_title_raw string")
    docs = spark.createDataFrame([("d", kind, "x", "2022-07-13")], "document_id string, doc_type_category string, institution string, document_date string")
    return enrich.enrich_chunks(chunks.withColumn("page_start", F.lit(1)).withColumn("page_end", F.lit(1)), docs, OWN).orderBy("position_in_doc").collect()


def test_enrichment(spark):
    r = _rich(spark, ["El Consejo acordó subir la TPM y la inflación cae 5,25% en 2022", "copyright tpm 3%", "nada", "se espera que el cobre suba"], titles={2: "Riesgos del escenario"})
    assert r[0]["section_type"] == "DECISION" and r[0]["is_policy_decision"] and r[0]["tags"] == ["DECISION_POLITICA", "DATOS_NUMERICOS", "VARIABLE_CRITICA"]
    assert r[0]["economic_variables"]["INFLACION"]["confidence"] == 0.5 and set(r[0]["economic_variables"]) == {"TASA_INTERES", "INFLACION"}
    assert r[0]["importance_score"] == round(0.35 + 0.10 + 0.20 / 3 + 0.25 + 0.05, 3)  # "el consejo acordo" names an entity
    assert r[1]["importance_score"] == 0.0
    assert (r[2]["section_type"], r[2]["section_confidence"], r[2]["importance_score"]) == ("RIESGOS", 0.95, 0.03)
    assert r[3]["is_forward_looking"] and r[3]["importance_score"] == round(0.20 + 0.15 + 0.08, 3)
    m = _rich(spark, ["texto"], "MONITOR_PM", {0: "Renta Fija"})
    assert (m[0]["section_type"], m[0]["section_confidence"]) == ("RENTA_FIJA", 1.0)


def test_chunks_without_documents(spark):
    chunks = spark.createDataFrame([("a_0000", "a", None, 0, 0, None, 1, 1)], "chunk_id string, document_id string, text string, char_count int, position_in_doc int, section_title_raw string, page_start int, page_end int")
    docs = spark.createDataFrame([], "document_id string, doc_type_category string, institution string, document_date string")
    r = enrich.enrich_chunks(chunks, docs).first()
    assert (r["doc_type_category"], r["institution"]) == ("REPORTE_RESEARCH", "unknown")


def test_embed_text(spark):
    row = spark.range(1).select(F.lit("t").alias("text"), F.lit("MINUTA").alias("doc_type_category"), F.lit("DATOS").alias("section_type"), F.expr("map('CREDITO', named_struct('importance', 'MEDIUM'), 'PIB', named_struct('importance', 'CRITICAL'), 'EMPLEO', named_struct('importance', 'HIGH'), 'TASA_INTERES', named_struct('importance', 'CRITICAL'))").alias("economic_variables"))
    assert enrich.embed_text(row, "m").first()["embed_text"] == "[MINUTA | DATOS | TASA_INTERES, PIB, EMPLEO] t"
    assert enrich.embed_text(row, "E5", context=False).first()["embed_text"] == "passage: t"


def test_taxonomy_tables(spark):
    table = spark.createDataFrame(X.DOMAIN.with_keywords({n: [n.lower()] for n in X.VARIABLES}).rows(), "kind string, name string, ord int, keyword string, kw_ord int, importance string")
    again = X.from_table(table)
    assert again == X.DOMAIN.with_keywords({n: [n.lower()] for n in X.VARIABLES}) and list(again.sections) == list(X.DOMAIN.sections)


def test_built_in_lists(tmp_path):
    sizes = lambda named: sum(map(len, named.values()))
    assert (len(X.DOMAIN.variables), sizes(X.DOMAIN.sections), len(X.DOMAIN.entities), sizes(X.DOMAIN.entities), len(X.DOMAIN.boilerplate), len(X.DOMAIN.forward)) == (18, 135, 20, 102, 51, 11)
    assert (len(X.BASIC_DOMAIN.variables), len(X.BASIC_DOMAIN.entities), sizes(X.BASIC_DOMAIN.entities), len(X.BASIC_DOMAIN.boilerplate)) == (14, 8, 39, 11)
    assert not any(words for t in (X.DOMAIN, X.BASIC_DOMAIN) for _, words in t.variables.values())
    (tmp_path / "own.json").write_text('{"PIB": ["pib"], "NEW": ["x"]}')
    own = X.from_json(str(tmp_path / "own.json"), X.BASIC_DOMAIN)
    assert own.variables["PIB"] == ("CRITICAL", ["pib"]) and own.variables["NEW"] == ("MEDIUM", ["x"]) and own.sections == X.SECTIONS


def test_vectors(spark):
    r = spark.range(1).select(V.dot(V.literal([1, 2]), V.literal([3, 4])), V.cosine(V.literal([1, 0]), V.literal([0, 0])), V.reconciled(V.literal([1, 2, 3]), 2), V.reconciled(V.literal([1]), 3), V.formatted(V.literal([0.5, -1])), V.parsed(F.lit("[0.5,-1]")), V.unit(V.literal([3, 4]))).first()
    assert tuple(r) == (11.0, None, [1.0, 2.0], [1.0, 0.0, 0.0], "[0.5000000,-1.0000000]", [0.5, -1.0], [0.6, 0.8])


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ("tasa de interés 2022", {"year_from": 2022, "year_to": 2022, "variables": ["TASA_INTERES"], "clean_query": "tasa de interés"}),
        ("ipc 2023-2021", {"year_from": 2021, "year_to": 2023, "clean_query": "ipc"}),
        ("ipc 2020 a 2022", {"year_from": 2020, "year_to": 2022}),
        ("acuerdo 13 de julio de 2022", {"exact_date": "2022-07-13", "month": 7, "year_from": 2022, "clean_query": "acuerdo"}),
        ("acuerdo 13-07-22", {"exact_date": "2022-07-13", "year_from": None, "clean_query": "acuerdo"}),
        ("acuerdo 2022-07-13", {"exact_date": None, "year_from": 2022}),
        ("Julio 2022", {"month": 7, "clean_query": "Julio"}),
        ("julio 2022", {"month": 7, "clean_query": "julio 2022"}),
        ("31-02-2022 x", {"exact_date": None}),
        ("que hace la fed", {"doc_types": ["FED_STATEMENT"], "sections": ["CONTEXTO_EXTERNO"]}),
        ("empleo en chile", {"sections": [], "variables": ["EMPLEO"]}),
        ("contexto interno", {"sections": ["CONTEXTO_INTERNO"]}),
    ],
)
def test_query_parser(query, want):
    got = parse.parse_query(query, OWN)
    assert {k: got[k] for k in want} == want
    assert parse.month_numbers("enero, feb,3,x,13") == [1, 2, 3]


def test_basic_profile():
    got = parse.parse_query("13 de julio de 2022 en chile", profile=BASIC)
    assert (got["exact_date"], got["month"], got["year_from"], got["sections"]) == (None, None, 2022, ["CONTEXTO_INTERNO"])


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "Minuta_17-01-13.pdf").write_bytes(b"not a pdf")
    common = ["--store", f"file://{tmp_path}/s", "--work", f"file://{tmp_path}/w"]
    assert cli.main([*common, "extract", str(tmp_path / "data")]) == 0
    assert cli.main([*common, "setup"]) == 0 and cli.main([*common, "stats"]) == 0
    assert cli.main([*common, "search", "tasa 2022"]) == 0 and "Sin resultados" in capsys.readouterr().out
    assert cli.main([*common, "prompt", "tasa 2022"]) == 0 and "### PREGUNTA" in capsys.readouterr().out
    config = str(tmp_path / "f.json")
    assert cli.main([*common, "advanced", "tasa", "--years", "2022", "--months", "julio", "--save-config", config]) == 0
    assert cli.main([*common, "advanced", "--config", config, "--min-importance", "0.2", "--json"]) == 0
    assert '"min_importance": 0.2' in capsys.readouterr().out


def test_filters_round_trip(tmp_path):
    own = filters.AdvancedFilters.from_dict({"years": 2022, "entities": ["A"], "exclude_boilerplate": True})
    own.save(tmp_path / "f.json")
    assert filters.AdvancedFilters.load(tmp_path / "f.json") == own and own.active() == 3 and own.years == [2022]
    with pytest.raises(ValueError, match="unknown"):
        filters.AdvancedFilters.from_dict({"yers": 1})


def test_cover_density(spark):
    def plain(words, terms):
        hits = [(i, w) for i, w in enumerate(words) if w in terms]
        covers = []
        for i, _ in hits:
            for j, _ in hits:
                inside = [w for k, w in hits if i <= k <= j]
                if set(inside) == set(terms):
                    covers.append((i, j, len(inside)))
        minimal = [c for c in covers if not any(o != c and c[0] <= o[0] and o[1] <= c[1] for o in covers)]
        return sum(0.1 / (1 + j - i + 1 - n) for i, j, n in minimal)

    r = np.random.default_rng(0)
    some = [" ".join(r.choice(["a", "b", "x", "y"], int(r.integers(0, 14)))) for _ in range(40)]
    got = column(spark, lambda x: recall.cover_density(x, ["a", "b"]), *some)
    assert got == pytest.approx([plain(s.split(), ["a", "b"]) for s in some])
    assert recall.query_lexemes("Año 2022, AÑO-x") == ["año", "2022", "x"]


def test_mmr_extremes(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(12, 4))
    q = r.normal(size=4)
    rows = spark.createDataFrame([(f"c{i}", [float(y) for y in x], i) for i, x in enumerate(v)], "chunk_id string, embedding array<double>, order int")
    order = [x["chunk_id"] for x in fuse.mmr(rows, list(q), 20, 1.0).orderBy("mmr_rank").collect()]
    assert order == [f"c{i}" for i in np.argsort(-(v @ q), kind="stable")]
    assert [x["mmr_rank"] for x in fuse.mmr(rows, list(q), 3, 0.0).collect()] == [1, 2, 3]
    both = rows.crossJoin(spark.createDataFrame([(1, [float(x) for x in q]), (2, [1.0, 0.0, 0.0, 0.0])], "query_id int, q array<double>"))
    assert fuse.mmr(both, None, 5, by=["query_id"], query_col="q").groupBy("query_id").count().count() == 2


def test_rrf_of_disjoint_and_empty_lists(spark):
    a = spark.createDataFrame([("x", 0.9), ("y", 0.9)], "chunk_id string, vector_score double")
    b = spark.createDataFrame([("y", 2.0)], "chunk_id string, lexical_score double")
    got = {r["chunk_id"]: r["rrf_score"] for r in fuse.rrf([fuse.ranked(a, "vector_score"), fuse.ranked(b, "lexical_score")]).collect()}
    assert got == pytest.approx({"x": 1 / 61, "y": 1 / 62 + 1 / 61})
    assert fuse.fuse(a.where("false"), b.where("false")).count() == 0


def test_order_statistics(spark):
    r = np.random.default_rng(2)
    values = sorted(int(x) for x in r.integers(0, 30, 97))
    got = tuple(stats.order_statistics(spark.createDataFrame([(v,) for v in values], "x int"), "x").first())
    n = len(values)
    assert got == (values[0], values[n // 4], values[n // 2], values[3 * n // 4], values[9 * n // 10], values[-1], sum(values) // n)
    assert stats.order_statistics(spark.createDataFrame([], "x int"), "x").first()["min"] is None


def _loaded(spark, tmp_path):
    load = embed.hashed_words(16)
    docs = spark.createDataFrame(
        [
            ("minuta_jul22", "Minuta_13-07-22.pdf", "Minutas/Minuta_13-07-22.pdf", "MINUTA", "banco_central_chile", "2022-07-13", ["DECISIÓN\n\nEl Consejo acordó subir la tasa de interés 75 puntos base por la inflación.", "Otros temas del mercado laboral."]),
            ("fed_2023", "fed.pdf", "Fed/fed.pdf", "FED_STATEMENT", "federal_reserve", "2023-02-01", ["The Committee raised the interest rate. Inflation risks remain and the outlook is uncertain."]),
        ],
        "document_id string, filename string, filepath string, doc_type_category string, institution string, document_date string, pages array<string>",
    )
    s = store.Store(spark, f"file://{tmp_path}/store", "t_")
    s.setup()
    documents, chunks = ingest.stages(docs, load, "hashed", OWN)
    assert s.load(documents, chunks, 16) == 0
    return s, docs, load


def test_store_and_search(spark, tmp_path):
    s, docs, load = _loaded(spark, tmp_path)
    embedder = lambda q: embed.query_vector(q, load, "hashed")
    first = s.read("chunks").count()
    hits, parsed = search.search(s.read("chunks"), s.read("documents"), "tasa de interés 2022", embedder, 3, taxonomy=OWN)
    assert parsed["year_from"] == 2022 and [r["document_id"] for r in hits.collect()] == ["minuta_jul22"]
    assert [r["document_id"] for r in search.search(s.read("chunks"), s.read("documents"), "petroleo 2023", embedder, 3, taxonomy=OWN)[0].collect()] == ["fed_2023"]
    assert search.search(s.read("chunks"), s.read("documents"), "algo de 1999", embedder, 3)[0].count() == 0
    month = search.search(s.read("chunks"), s.read("documents"), "tasa julio", embedder, 3)[0].collect()
    assert {r["document_id"] for r in month} == {"minuta_jul22"}
    own = filters.AdvancedFilters.from_dict({"institutions": "federal_reserve", "years": [2023]})
    assert {r["document_id"] for r in search.advanced_search(s.read("chunks"), s.read("documents"), own, "interest rate").collect()} == {"fed_2023"}
    assert search.advanced_search(s.read("chunks"), s.read("documents"), own, k=1).count() == 1

    # A reload replaces its documents; a wrong dimension changes nothing.
    documents, chunks = ingest.stages(docs.where("document_id = 'fed_2023'"), load, "hashed")
    created = {r["document_id"]: r["created_at"] for r in s.read("documents").collect()}
    s.load(documents, chunks, 16)
    assert s.read("chunks").count() == first and {r["document_id"]: r["created_at"] for r in s.read("documents").collect()} == created
    with pytest.raises(ValueError, match="dimensions"):
        s.load(documents, chunks, 8)
    assert store.valid_chunks(s.read("chunks").withColumn("embedding", F.lit(None).cast("array<float>")), 16).count() == 0

    numbered = prompt.numbered(hits, [F.desc("final_score"), F.col("chunk_id")])
    text, cited = prompt.prompt("¿tasa?", numbered)
    assert "[1] Minuta_13-07-22.pdf p" in text and cited[0]["citation_number"] == 1 and text.endswith("### RESPUESTA")
    assert "QUERY: tasa" in prompt.text_report(numbered, parsed) and '"results"' in prompt.json_report(numbered, parsed)
    assert "(Sin fragmentos" in prompt.context_block(numbered.where("false"), "x")
    s.setup(drop=True)
    assert s.read("chunks").count() == 0


FAKE_READER = """
class _Page:
    def __init__(self, text):
        self.text = text
    def extract_text(self):
        return self.text
class PdfReader:
    is_encrypted = False
    def __init__(self, source):
        held = source.read().decode()
        if not held.startswith("%PDF"):
            raise ValueError("no PDF")
        self.pages = [_Page(t) for t in held.removeprefix("%PDF").split(chr(12))]
"""


def test_command_line_loads_all_documents(spark, tmp_path, capsys):
    """Several documents in one part file, through JSON and into the tables; a stand-in reads the pages."""
    (tmp_path / "pypdf.py").write_text(FAKE_READER)
    spark.sparkContext.addPyFile(str(tmp_path / "pypdf.py"))
    (tmp_path / "data").mkdir()
    for i in range(7):
        page = f"El Consejo acordó subir la tasa de interés {i} puntos base. " * 30
        (tmp_path / "data" / f"Minuta_{10 + i}-01-13.pdf").write_text("%PDF" + page + chr(12) + "RIESGOS\n\n" + page)
    common = ["--store", f"file://{tmp_path}/s", "--work", f"file://{tmp_path}/w", "--dimension", "16"]
    assert cli.main([*common, "full", str(tmp_path / "data")]) == 0
    assert "with_warnings" in capsys.readouterr().out
    stored = store.Store(spark, f"file://{tmp_path}/s")
    documents, chunks = files.extract(spark, str(tmp_path / "data"))
    assert stored.read("documents").count() == documents.count() == 7
    rows = {r["chunk_id"]: r for r in stored.read("chunks").collect()}
    assert set(rows) == {r["chunk_id"] for r in chunks.collect()} and len(rows) > 14
    assert all(r["embedding"] and r["section_type"] for r in rows.values())
    assert {(r["document_id"], r["total_chunks"]) for r in stored.read("documents").collect()} == {(r["document_id"], r["count"]) for r in chunks.groupBy("document_id").count().collect()}
    assert cli.main([*common, "enrich"]) == 0 and cli.main([*common, "load"]) == 0
    assert stored.read("chunks").count() == len(rows) and stored.read("documents").count() == 7


def test_json_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{i}", "ñ\n" * i, None if i % 2 else i) for i in range(10)], "document_id string, filename string, total_pages int")
    store.write_json(docs.coalesce(1), f"file://{tmp_path}/lines")
    back = store.read_documents_json(spark, f"file://{tmp_path}/lines").select(*docs.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    (tmp_path / "array.json").write_text('[{"document_id": "a"},\n {"document_id": "b"}]')
    assert [r["document_id"] for r in store.read_documents_json(spark, f"file://{tmp_path}/array.json", arrays=True).collect()] == ["a", "b"]


def test_failed_load_changes_nothing(spark, tmp_path, monkeypatch):
    s, docs, load = _loaded(spark, tmp_path)
    before = [sorted(map(str, s.read(t).collect())) for t in ("documents", "chunks")]
    planned = s.read("chunks")
    more = docs.withColumn("document_id", F.concat("document_id", F.lit("_new")))
    documents, chunks = ingest.stages(more, load, "hashed")
    own = store.Store._written

    def failing(self, table, df, buckets):
        if table == "chunks":
            raise RuntimeError("no space left")
        return own(self, table, df, buckets)

    monkeypatch.setattr(store.Store, "_written", failing)
    with pytest.raises(RuntimeError, match="no space"):
        s.load(documents, chunks, 16)
    monkeypatch.undo()
    assert [sorted(map(str, s.read(t).collect())) for t in ("documents", "chunks")] == before
    s.load(documents, chunks, 16)
    assert s.read("documents").count() == 4 and s.read("chunks").count() == 2 * len(before[1])
    assert sorted(map(str, planned.collect())) == before[1]  # a reader of the version before
    s.load(*ingest.stages(docs.limit(1), load, "hashed"), 16)
    assert s.read("documents").count() == 4


def test_loads_touch_their_buckets_only(spark, tmp_path):
    s, docs, load = _loaded(spark, tmp_path)
    old = s._version()["tables"]["documents"]
    s.load(*ingest.stages(docs.where("document_id = 'fed_2023'"), load, "hashed"), 16)
    new = s._version()["tables"]["documents"]
    assert len(old) == len(new) == 2 and len(set(old.values()) & set(new.values())) == 1


def test_latest_row_of_a_document(spark):
    rows = spark.createDataFrame([("a", "2020", 1), ("a", "2021", 2), ("a", None, 3), ("b", None, 4)], "document_id string, document_date string, n int").repartition(3)
    assert sorted((r["document_id"], r["n"]) for r in store.latest(rows).collect()) == [("a", 2), ("b", 4)]


def test_query_models_are_loaded_once():
    calls = []

    def load():
        calls.append(1)
        return embed.hashed_words(8)()

    assert embed.query_vector("a b", load, "m") == embed.query_vector("a b", load, "m") and len(calls) == 1


def test_vector_literals_are_those_of_the_sql(spark, tmp_path):
    """Negative values that round to zero keep their sign, as do zeros; ties, large values, what is no number, and nulls."""
    import duckdb
    from corvane.plans import catalog

    odd = [-1e-9, -4.9e-8, -5e-8, 5e-8, 0.0, -0.0, 2.0**-8, 3 * 2.0**-8, -(2.0**-8), 16777217.0, 3.4e38, -1e-45, float("nan"), float("inf"), float("-inf"), 1.5]
    rows = [(0, odd), (1, [*odd, None]), (2, []), (3, None), (4, [None])] + [(5 + i, [x]) for i, x in enumerate(odd)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, catalog.vector_literal(spark, f"file://{tmp_path}").collect()))
    sql = catalog.oracle_sql()["vector_literal"].replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == sorted(duckdb.sql(sql).fetchall()) and "-0.0000000" in got[0][1]


def test_extraction_warnings(spark):
    docs = spark.createDataFrame([("a", 3, []), ("b", 0, ["x", "y"]), ("c", 0, []), ("d", 1, ["z"])], "filename string, total_chunks int, extraction_warnings array<string>")
    assert tuple(stats.extraction_report(docs).first()) == (4, 4, 2, 2)
    assert sorted(map(str, map(tuple, stats.extraction_warnings(docs).collect()))) == sorted(map(str, [("b", True, "x"), ("b", True, "y"), ("c", True, None), ("d", False, "z")]))


def test_index_finds_neighbours(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    own = index.build(rows.unionByName(spark.createDataFrame([(-1, None), (-2, []), (-3, [1.0])], "vec_id long, embedding array<float>")), f"file://{tmp_path}/i", id_col="vec_id")
    assert own.rows.count() == rows.count()
    hits = 0
    some = rows.where("vec_id % 500 = 0").collect()
    for r in some:
        near = {x["vec_id"] for x in own.near(r["embedding"], 20, id_col="vec_id").collect()}
        exact = {x["vec_id"] for x in recall.vector_recall(rows, r["embedding"], 20, id_col="vec_id").collect()}
        hits += len(near & exact)
    assert hits >= 0.9 * 20 * len(some)
    every = own.near(some[0]["embedding"], 20, id_col="vec_id", probes=len(own.centroids)).collect()
    assert [r["vec_id"] for r in every] == [r["vec_id"] for r in recall.vector_recall(rows, some[0]["embedding"], 20, id_col="vec_id").collect()]
    nothing = index.build(rows.where("false"), f"file://{tmp_path}/n", id_col="vec_id")
    assert nothing.near([1.0], 5, id_col="vec_id").count() == 0


def test_search_with_an_index(spark, tmp_path):
    s, _, load = _loaded(spark, tmp_path)
    embedder = lambda q: embed.query_vector(q, load, "hashed")
    own = index.build(s.read("chunks"), f"file://{tmp_path}/index")
    exact = search.search(s.read("chunks"), s.read("documents"), "interest rate 2023", embedder, 3, taxonomy=OWN)[0].collect()
    near = search.search(s.read("chunks"), s.read("documents"), "interest rate 2023", embedder, 3, taxonomy=OWN, index=own)[0].collect()
    assert [r["chunk_id"] for r in exact] == [r["chunk_id"] for r in near] and near


def test_long_documents_chunk_as_plain_code_does(spark):
    r = np.random.default_rng(8)
    lines = [" ".join(["palabra"] * int(r.integers(1, 30))) for _ in range(3000)]
    docs = spark.createDataFrame([("d", ["\n".join(lines[:1700]), "\n".join(lines[1700:])])], "document_id string, pages array<string>")
    got = chunking.chunk_documents(docs, longest=1 << 30, paragraph_break="\n", clean=False).orderBy("position_in_doc").collect()
    want = fold([(t, 1 if i < 1700 else 2, None) for i, t in enumerate(lines)])
    assert [[g["text"], g["page_start"], g["page_end"], g["section_title_raw"]] for g in got] == want and got[0]["total_in_doc"] == len(want)


def test_stream(spark, tmp_path):
    s, docs, load = _loaded(spark, tmp_path)
    s.setup(drop=True)
    docs.repartition(2).write.parquet(f"{tmp_path}/in")
    schema = "document_id string, filename string, filepath string, doc_type_category string, institution string, document_date string, pages array<string>"
    q = ingest.ingest(ingest.documents_stream(spark, f"{tmp_path}/in", schema), s, load, "hashed", 16, f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert {r["document_id"] for r in s.read("documents").collect()} == {"minuta_jul22", "fed_2023"}


def test_names_are_guarded(spark):
    with pytest.raises(ValueError, match="no table name"):
        store.Store(spark, "/tmp/x", "a; DROP TABLE b")


def test_upsert_keeps_and_replaces(spark):
    old = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], "document_id int, x string, created_at string")
    new = spark.createDataFrame([(2, "c", "t1"), (3, "d", "t1"), (3, "d", "t1")], "document_id int, x string, created_at string")
    assert sorted(map(tuple, store.upsert(old, new).collect())) == [(1, "a", "t0"), (2, "c", "t0"), (3, "d", "t1")]


def test_files_without_readers_warn(spark, tmp_path):
    (tmp_path / "Minutas").mkdir()
    (tmp_path / "Minutas" / "Minuta_17-01-13.pdf").write_bytes(b"not a pdf")
    (tmp_path / "Monitor PM.xlsx").write_bytes(b"not a sheet")
    documents, chunks = files.extract(spark, str(tmp_path))
    got = {r["document_id"]: r for r in documents.collect()}
    assert got["minutas_minuta_17_01_13"]["document_date"] == "2013-01-17" and got["monitor_pm"]["doc_type_category"] == "MONITOR_PM"
    assert all(r["extraction_warnings"] for r in got.values()) and chunks.count() == 0


def test_page_warnings(spark):
    rows = spark.createDataFrame([(["This is a protected document"], []), (["x" * 600], []), (["short"], []), (["short"], ["w"])], "pages array<string>, extraction_warnings array<string>")
    assert [r["extraction_warnings"] for r in files.with_warnings(rows).collect()] == [["protected document"], [], ["little text: scanned?"], ["w"]]


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    own = duckdb.connect()
    for t in ("customer", "orders", "documents", "embeddings", "pages", "labels", "conversations", "events"):
        own.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = catalog.queries()[name](spark, sf)
    table = own.sql(catalog.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(table.columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(repr, table.select(", ".join(f'"{c}"' for c in columns)).fetchall()))
