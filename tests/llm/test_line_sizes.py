"""Line dedup on texts of very many lines, whose time follows their number."""

import time

from corvane.llm import linededup, queries
from pyspark.sql import functions as F


def test_texts_of_a_hundred_thousand_lines(spark):
    n = 100_000
    common = "\n".join(f"shared line {i}" for i in range(n // 2))
    rows = [(k, "\n".join([common, *[f"own {k} {i}" for i in range(n // 2)]]), f"site{k}") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    began = time.perf_counter()
    out = {r["doc_id"]: r for r in linededup.line_dedup(docs, min_sites=3).select("doc_id", F.md5("text").alias("digest"), F.char_length("text").alias("size"), "n_lines", "n_removed").collect()}
    assert time.perf_counter() - began < 60  # array searches by line took minutes
    assert [(out[k]["n_lines"], out[k]["n_removed"]) for k in range(4)] == [(n, 0), *[(n, n // 2)] * 3]
    assert out[0]["size"] == len(rows[0][1]) and out[2]["size"] == len(rows[2][1]) - len(common) - 1


def test_few_sites_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    own = duckdb.connect()
    own.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in queries.line_dedup_few_sites(spark, sf).collect())
    want = sorted(own.sql(queries.oracle_sql()["line_dedup_few_sites"]).fetchall())
    assert got == want and sum(r[3] for r in got) > sum(r["n_removed"] for r in queries.op3_line_dedup(spark, sf).collect())
