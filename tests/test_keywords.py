"""Keyword lists counted in one pass against a regular expression for each list."""

import random
import re

import pytest
from corvane.functions import keywords
from corvane.functions import text as T
from corvane.functions.taxonomy import DOMAIN, Taxonomy
from corvane.operators import enrich
from pyspark.sql import functions as F


def by_pattern(text, lists):
    return [len(re.findall(T.word_pattern(words), text)) for words in lists]


@pytest.mark.parametrize("seed", range(5))
def test_random_lists(seed):
    r = random.Random(seed)
    letters = "ab1 -.é"
    word = lambda n: "".join(r.choices(letters, k=r.randint(1, n)))
    lists = tuple(tuple(word(5) for _ in range(r.randint(0, 6))) for _ in range(8))
    for _ in range(200):
        text = T.normalized(word(60))
        assert keywords.counted(text, lists) == by_pattern(text, lists), (text, lists)


def test_the_first_of_a_list_wins_and_matches_do_not_overlap():
    assert keywords.counted("tasa de interes, tasa", (("tasa", "tasa de interes"), ("tasa de interes", "tasa"), ("interes tasa",), ("de interes, tasa", "tasa de"), ())) == [2, 2, 0, 1, 0]
    assert keywords.counted("", (("a",),)) == [0] and keywords.counted("a", ((), (" ",))) == [0, 0]


def test_columns_with_and_without_counts(spark):
    own = Taxonomy(variables={"A": ("CRITICAL", ["tasa", "tasa de"]), "B": ("HIGH", ["pib"])}, sections={"DECISION": ["acordo"], "RIESGOS": ["tasa"]}, entities={"E": ["fed", "the fed"]}, forward=["se espera"], boilerplate=["derechos reservados"])
    r = random.Random(9)
    words = ["tasa", "de", "pib", "acordó", "fed", "the", "se", "espera", "derechos", "reservados", "x", "tasas", "PIB,"]
    rows = spark.createDataFrame([(i, " ".join(r.choices(words, k=r.randint(0, 12)))) for i in range(150)] + [(150, None)], "i int, text string")
    for taxonomy in (own, DOMAIN, Taxonomy()):
        base = rows.withColumn("normal", T.normalize_text(F.col("text"))).withColumn("counts", enrich.keyword_counts(F.coalesce("normal", F.lit("")), taxonomy))
        n, numbers = F.coalesce("normal", F.lit("")), F.array().cast("array<string>")

        def made(c):
            v, e = enrich.variables(n, taxonomy, c), enrich.entities(n, taxonomy, c)  # noqa: B023
            s = enrich.section(n, F.lit(2), F.lit(9), F.lit(None).cast("string"), taxonomy, c)  # noqa: B023
            return [F.to_json(v), F.to_json(e), s["type"], s["confidence"], enrich.tags(n, v, numbers, s["type"], taxonomy, c), enrich.importance(n, v, numbers, s["type"], e, enrich.forward(n, taxonomy, c), taxonomy, counts=c)]  # noqa: B023

        one, other = (sorted(map(str, base.select("i", *[x.alias(f"c{k}") for k, x in enumerate(made(c))]).collect())) for c in (None, F.col("counts")))
        assert one == other


def test_one_pass_in_the_plan(spark):
    chunks = spark.createDataFrame([("d_0", "d", "tasa", 0, None)], "chunk_id string, document_id string, text string, position_in_doc int, section_title_raw string").withColumn("total_in_doc", F.lit(1))
    documents = spark.createDataFrame([("d", "MINUTA", "x", "2024")], "document_id string, doc_type_category string, institution string, document_date string")
    plan = enrich.enrich_chunks(chunks, documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_count" not in plan.lower() and "regexpcount" not in plan.lower()
