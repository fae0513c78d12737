"""Recall for many queries at once against one query at a time."""

import random

from corvane.operators import index, many, recall
from corvane.plans import more
from pyspark.sql import functions as F


def test_vectors(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)], "ab"[i % 2]) for i in range(300)] + [(300 + i, [1.0] * 6, "a") for i in range(60)] + [(400, None, "a"), (401, [], "a"), (402, [0.0] * 6, "a"), (403, [1.0, 2.0], None), (404, [float("nan")] * 6, "b")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, lang string").repartition(3)
    queries = {f"q{i}": rows[i * 7][1] for i in range(12)} | {"ones": [1.0] * 6, "short": [2.0, 1.0], "zero": [0.0] * 6}
    groups = {"q3": ["a"], "ones": ["a", "b"], "q5": ["none"]}
    got = {}
    for x in many.vector_recall(table, queries, 10, id_col="vec_id", group_col="lang", groups=groups).collect():
        got.setdefault(x["query"], []).append((x["rank"], x["vec_id"], round(x["vector_score"], 9)))
    for name, vector in queries.items():
        some = table.where(F.col("lang").isin(groups[name])) if name in groups else table
        fine = some.where("vec_id <> 404")
        want = fine.withColumn("s", recall.V.cosine(F.col("embedding"), recall.V.literal(vector))).where((F.size("embedding") == len(vector)) & F.col("s").isNotNull()).orderBy(F.desc(F.round("s", 12)), "vec_id").limit(10).collect()
        assert sorted(got.get(name, [])) == [(i, x["vec_id"], round(x["s"], 9)) for i, x in enumerate(want, 1)], name
    assert [x[1] for x in sorted(got["ones"])] == list(range(300, 310))
    assert many.vector_recall(table, {}, 10, id_col="vec_id").count() == 0


def test_many_ties_within_a_task_keep_the_smallest_identifiers(spark):
    table = spark.range(2000).select((1999 - F.col("id")).alias("vec_id"), F.array(F.lit(1.0), F.lit(1.0)).alias("embedding")).coalesce(1)
    assert [x["vec_id"] for x in many.vector_recall(table, {"q": [1.0, 1.0]}, 5, id_col="vec_id").orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_texts(spark, monkeypatch):
    monkeypatch.setattr(many, "BLOCK", 2)
    r = random.Random(3)
    words = ["la", "de", "Tasa", "the", "of", "ß", "2020"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 30))), ["en", "es", None][i % 3]) for i in range(200)] + [(200, None, "en"), (201, "", "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    queries = {"a": "la de", "b": "The OF the", "c": "absent", "d": "", "e": "tasa 2020 ß"}
    groups = {"a": ["es", "en"]}
    got = {}
    for x in many.lexical_recall(table, queries, 9, id_col="doc_id", group_col="lang", groups=groups).collect():
        got.setdefault(x["query"], []).append((x["rank"], x["doc_id"], round(x["lexical_score"], 9)))
    for name, query in queries.items():
        some = table.where(F.col("lang").isin(groups[name])) if name in groups else table
        want = recall.lexical_recall(some, query, 1000, id_col="doc_id").orderBy(F.desc(F.round("lexical_score", 6)), "doc_id").limit(9).collect()
        assert sorted(got.get(name, [])) == [(i, x["doc_id"], round(x["lexical_score"], 9)) for i, x in enumerate(want, 1)], name
    assert got["a"] and got["e"]


def test_a_table_of_queries_meets_the_rows_in_blocks(spark, tmp_path, monkeypatch):
    """Exact and by cells, over several blocks and parts: the rows that one query at a time finds, without its own id."""
    monkeypatch.setattr(many, "ROWS_BLOCK", 6 * 70)
    monkeypatch.setattr(many, "QUERIES_PART", 6 * 20)
    monkeypatch.setattr(many, "STEP", 7)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(300)] + [(300 + i, [1.0] * 6) for i in range(60)] + [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, 2.0]), (404, [float("nan")] * 6), (405, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    asked = table.where("vec_id % 5 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("x"))
    fine = {r["vec_id"]: r["embedding"] for r in table.where("vec_id < 400").collect()}

    def of(found):
        out = {}
        for x in found.collect():
            out.setdefault(x["query"], []).append((x["rank"], x["vec_id"], round(x["vector_score"], 9)))
        return {q: sorted(x) for q, x in out.items()}

    def want(q, some):
        near = some.where(F.col("vec_id").isin(*fine) & (F.col("vec_id") != q)).withColumn("s", recall.V.cosine(F.col("embedding"), recall.V.literal(fine[q]))).orderBy(F.desc(F.round("s", 12)), "vec_id").limit(10)
        return [(i, x["vec_id"], round(x["s"], 9)) for i, x in enumerate(near.collect(), 1)]

    exact = of(many.nearest(table, asked, 10, 6))
    assert set(exact) == {i for i in fine if i % 5 == 0}
    for q in (0, 35, 300, 355):
        assert exact[q] == want(q, table), q
    own = index.build(table, f"file://{tmp_path}/i", id_col="vec_id")
    own.probes = len(own.centroids)
    assert of(own.near_many(asked, 10, id_col="vec_id")) == exact
    own.probes = 3
    by_cells = of(own.near_many(asked, 10, id_col="vec_id"))
    for q in (0, 35, 300):
        assert by_cells[q] == want(q, own.cells(fine[q])), q
    assert many.nearest(table.where("false"), asked, 10, 6).count() == many.nearest(table, asked.where("false"), 10, 6).count() == 0


def test_the_recall_of_an_index_is_measured_without_nested_loops(spark):
    """All pairs used to be one nested-loop join with a broadcast table, of four expressions a pair."""
    found = more.index_recall(spark, "/root/testdata/sf0.001")
    assert found._jdf.queryExecution().executedPlan().toString().count("NestedLoopJoin") <= 1  # of two single rows
    assert found.first()["reached"]
