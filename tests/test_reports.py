"""Kept reports against the full aggregates, over loads, replaced documents and emptied tables."""

import random

from corvane.operators import stats
from corvane.sources.reports import Reports
from corvane.sources.store import Store


def rows_of(spark, ids, seed):
    r = random.Random(seed)
    documents = [(d, f"{d}.pdf", r.choice(["MINUTA", "COMUNICADO", None]), r.randint(0, 2), ["w"] if r.random() < 0.3 else []) for d in ids]
    chunks = [(f"{d}_{i:04d}", d, r.choice(["DECISION", "RIESGOS", None]), round(r.random(), 3), r.random() < 0.4, {v: ("HIGH", 1, 0.5) for v in "ABC" if r.random() < 0.5}, [1.0, 2.0] if r.random() < 0.9 else None) for d in ids for i in range(r.randint(0, 4))]
    return spark.createDataFrame(documents, "document_id string, filename string, doc_type_category string, total_chunks int, extraction_warnings array<string>").selectExpr("*", "'2024-01-01' AS document_date"), spark.createDataFrame(chunks, "chunk_id string, document_id string, section_type string, importance_score double, is_policy_decision boolean, economic_variables map<string,struct<importance:string,mentions:int,confidence:double>>, embedding array<float>")


def same(store, kept):
    chunks, documents = store.read("chunks"), store.read("documents")
    for got, want in ((kept.by_type(), stats.by_type(chunks, documents)), (kept.by_section(), stats.by_section(chunks)), (kept.importance_summary(), stats.importance_summary(chunks)), (kept.key_histogram(2), stats.key_histogram(chunks, "economic_variables", 2))):
        assert got.columns == want.columns and list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
    total = tuple(x or 0 for x in stats.extraction_report(documents).first())
    assert tuple(kept.extraction_report().first()) == total


def test_reports_follow_loads(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", buckets=4)
    kept = Reports(store, f"file://{tmp_path}/r")
    store.setup()
    assert kept.refresh() == 0 and kept.counts().count() == 0
    store.load(*rows_of(spark, [f"d{i}" for i in range(40)], 1), 2)
    same(store, kept)  # nothing kept yet
    assert kept.refresh() == 4 and kept.refresh() == 0
    same(store, kept)
    plan = kept.by_type()._jdf.queryExecution().executedPlan().toString()
    assert "chunk_id" not in plan and "economic_variables" not in plan and "/s/" not in plan  # no table is read
    store.load(*rows_of(spark, ["d3", "new"], 2), 2)
    same(store, kept)  # two buckets are counted on the way
    assert 0 < kept.refresh() <= 2
    same(store, kept)
    store.setup(drop=True)
    assert kept.refresh() == 0 and kept.counts().count() == 0
