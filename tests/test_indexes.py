"""Loads that run at once, and indexes that follow them: postings and cells against scans of the tables as they stand."""

import random

import numpy as np
import pytest
from corvane.operators import embed, lexical, recall
from corvane.plans import search
from corvane.sources.indexes import Indexes
from corvane.sources.store import Conflict, Store
from corvane.sources.versions import Versions
from pyspark.sql import functions as F

WORDS = ["tasa", "interés", "the", "of", "inflación", "PIB", "x1", "mercado", "ß", "ñandú"]


def rows_of(spark, ids, seed, dimension=8):
    """Documents and two to five chunks of each, with random vectors and words."""
    r = random.Random(seed)
    documents = spark.createDataFrame([(d, f"{d}.pdf", f"20{r.randint(10, 25)}-01-01") for d in ids], "document_id string, filename string, document_date string")
    chunks = [(f"{d}_{i:04d}", d, ", ".join(r.choices(WORDS, weights=range(len(WORDS), 0, -1), k=r.randint(0, 40))), i, r.random(), [r.gauss(0, 1) for _ in range(dimension)]) for d in ids for i in range(r.randint(2, 5))]
    return documents, spark.createDataFrame(chunks, "chunk_id string, document_id string, text string, page_start int, importance_score double, embedding array<float>")


def test_only_one_writer_makes_a_version(spark, tmp_path):
    one, two = (Versions(spark, f"file://{tmp_path}/v") for _ in range(2))
    assert one.current() == (0, {})
    assert one.made(1, {"by": "one"}) and not two.made(1, {"by": "two"})
    assert two.current() == (1, {"by": "one"})
    for n in range(2, 20):
        assert two.made(n, {"n": n})
    assert one.current() == (19, {"n": 19}) and len(one._numbers()) == 11
    assert not [p.name for p in (tmp_path / "v").iterdir() if len(p.name) > 17 and not p.name.endswith(".crc")]


def test_interleaved_loads_lose_nothing(spark, tmp_path):
    """Two loads that read the same version: other documents are both kept, and the same document is the later version's."""
    first, second = Store(spark, f"file://{tmp_path}/s", buckets=2), Store(spark, f"file://{tmp_path}/s", buckets=2)
    first.setup()
    a, b = rows_of(spark, ["a", "b", "c"], 1), rows_of(spark, ["c", "d"], 2)
    made, once = first._made, []

    def late(*args):  # the other load ends between this one's reading and its version
        if not once:
            once.append(second.load(*b, 8))
        return made(*args)

    first._made = late
    assert first.load(*a, 8) == 0
    assert {r["document_id"] for r in first.read("documents").collect()} == {"a", "b", "c", "d"}
    ids = {r["chunk_id"] for r in first.read("chunks").collect()}
    assert ids == {r["chunk_id"] for r in a[1].collect()} | {r["chunk_id"] for r in b[1].where("document_id = 'd'").collect()}
    assert first.version()["number"] == 3 and first.dimension() == 8


def test_loads_of_other_buckets_are_added_without_running_again(spark, tmp_path):
    first, second = Store(spark, f"file://{tmp_path}/s", buckets=64), Store(spark, f"file://{tmp_path}/s", buckets=64)
    a, b = rows_of(spark, ["a"], 1), rows_of(spark, ["b"], 2)
    made, merged, runs, once = first._made, first._merged, [], []

    def late(*args):
        if not once:
            once.append(second.load(*b, 8))
        return made(*args)

    first._made, first._merged = late, lambda *args: runs.append(1) or merged(*args)
    first.load(*a, 8)
    assert len(runs) == 1 and {r["document_id"] for r in second.read("documents").collect()} == {"a", "b"}


def test_a_load_gives_up_at_last(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s", buckets=1)
    s._made = lambda *args: False
    with pytest.raises(Conflict):
        s.load(*rows_of(spark, ["a"], 1), 8)
    assert s.read("documents").count() == 0


def test_another_dimension_stops_a_load(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    s.load(*rows_of(spark, ["a"], 1), 8)
    with pytest.raises(ValueError, match="dimensions"):
        s.load(*rows_of(spark, ["b"], 1, 4), 4)
    s.setup(drop=True)
    s.load(*rows_of(spark, ["b"], 1, 4), 4)
    assert s.dimension() == 4


def test_postings_give_the_scan_s_rows(spark):
    r = random.Random(4)
    texts = [(f"t{i:04d}", " ".join(r.choices(WORDS, weights=range(len(WORDS), 0, -1), k=r.randint(0, 60)))) for i in range(400)] + [("n", None), ("e", ""), ("dup", "the of"), ("dup", "the of")]
    rows = spark.createDataFrame(texts, "chunk_id string, text string").repartition(3)
    index = lexical.postings(rows).cache()
    distinct = rows.dropDuplicates(["chunk_id"])
    for query, sizes in (("the", (7,)), ("the of", (1, 1000)), ("inflación PIB the", (7,)), ("ñandú ß x1", (1000,)), ("the absent", (7,)), ("", (7,)), ("THE, Of", (3,))):
        for n in sizes:
            want = [tuple(x) for x in recall.lexical_recall(distinct, query, n).select("chunk_id", "lexical_score").collect()]
            got = [tuple(x) for x in lexical.top(index, recall.query_lexemes(query), n).collect()]
            assert got == want, query
    some = rows.where("chunk_id < 't0100'").select(F.col("chunk_id").alias("id"))
    assert {x["id"] for x in lexical.top(index, ["the", "of"], 500, some).collect()} == {x["chunk_id"] for x in recall.lexical_recall(rows.where("chunk_id < 't0100'"), "the of", 500).collect()}
    index.unpersist()


def test_recall_through_postings_reads_no_text(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s", buckets=4)
    s.load(*rows_of(spark, [f"d{i}" for i in range(30)], 1), 8)
    own = Indexes(s, f"file://{tmp_path}/i")
    assert own.refresh() == {"lexical": 4, "vectors": 4}
    assert own.refresh() == {"lexical": 0, "vectors": 0}
    version = s.version()
    found = own.at(version).lexical(s.frame(version, "chunks").select("chunk_id"), "the of", 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("text" in line.split("ReadSchema")[1] for line in scans)
    assert any("PushedFilters: [" in line and "In(term, [" in line for line in scans)


def test_indexes_follow_loads(spark, tmp_path):
    """New documents are found and replaced ones aren't, before and after the next refresh."""
    s = Store(spark, f"file://{tmp_path}/s", buckets=8)
    own = Indexes(s, f"file://{tmp_path}/i")
    assert own.refresh() == {"lexical": 0, "vectors": 0}
    s.load(*rows_of(spark, [f"d{i}" for i in range(60)], 1), 8)
    assert own.refresh(wanted=1.0)["vectors"] == 8

    def same(indexed):
        version = s.version()
        chunks, at = s.frame(version, "chunks"), own.at(version)
        assert (len(at.live) - len(at.words) > 0) != indexed
        ids = chunks.select("chunk_id")
        for query in ("inflación PIB",):
            assert [tuple(r) for r in at.lexical(ids, query, 10).collect()] == [tuple(r) for r in recall.lexical_recall(chunks, query, 10).select("chunk_id", "lexical_score").collect()]
        at.probes = 10_000  # all cells: exact
        vector = chunks.where("page_start = 1").orderBy("chunk_id").first()["embedding"]
        assert [tuple(r) for r in at.near(ids, vector, 10).collect()] == [tuple(r) for r in recall.vector_recall(chunks, vector, 10).select("chunk_id", "vector_score").collect()]

    same(True)
    s.load(*rows_of(spark, ["new", "d3"], 9), 8)
    same(False)
    assert 0 < own.refresh()["lexical"] < 8
    same(True)
    # Another index object, an index that never saw the tables, and emptied tables.
    assert own.refresh() == {"lexical": 0, "vectors": 0}
    same(True)
    s.setup(drop=True)
    assert own.at(s.version()).lexical(s.read("chunks").select("chunk_id"), "the", 5).count() == 0


def test_search_through_indexes_is_the_search_of_the_tables(spark, tmp_path):
    load = embed.hashed_words(8)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    embedder = lambda q: embed.query_vector(q, load, "hashed")
    s = Store(spark, f"file://{tmp_path}/s", buckets=4)
    own = Indexes(s, f"file://{tmp_path}/i")
    s.load(*rows_of(spark, [f"d{i}" for i in range(30)], 1), 8)
    own.refresh(wanted=1.0)
    s.load(*rows_of(spark, ["d3", "new"], 2), 8)
    for query in ("the of", "the desde 2018"):
        version = s.version()
        exact, _ = search.search(s.frame(version, "chunks"), s.frame(version, "documents"), query, embedder, 5)
        at = own.at(version)
        at.probes = 10_000
        through, _ = search.search(s.frame(version, "chunks"), s.frame(version, "documents"), query, embedder, 5, own=at, dimension=8)
        want, got = ([(r["chunk_id"], r["text"], round(r["final_score"], 9)) for r in x.collect()] for x in (exact, through))
        assert got == want and want
    hits, _ = search.search_store(s, own, "the of", embedder, 5)
    assert hits.count() == 5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before  # nothing stays cached


def test_cells_of_equal_vectors_are_several_tasks(spark, tmp_path):
    from corvane.operators import index

    rows = spark.createDataFrame([(f"c{i}", [1.0, 2.0]) for i in range(500)], "chunk_id string, embedding array<float>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = index.build(rows, f"file://{tmp_path}/i")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert own.rows.count() == 500 and len(own.rows.inputFiles()) > 1
    assert np.isclose(own.near([1.0, 2.0], 1).first()["vector_score"], 1)


def test_postings_shuffle_no_tokens(spark):
    """Tokens used to be dealt out one row each, in ranges."""
    rows = spark.createDataFrame([("a", "the of the"), ("b", None), ("c", " ".join(["x y"] * 50))], "chunk_id string, text string")
    assert "Exchange" not in lexical.postings(rows)._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in lexical.postings(rows.where("chunk_id < 'c'")).selectExpr("term", "id", "n", "array_join(at, ',')").collect()} == {("the", "a", 2, "0,2"), ("of", "a", 1, "1")}
    again = rows.unionByName(rows.selectExpr("chunk_id", "'of of' as text"))
    assert {tuple(r) for r in lexical.postings(again).where("id = 'a'").selectExpr("term", "id", "n", "array_join(at, ',')").collect()} == {("the", "a", 2, "0,2"), ("of", "a", 2, "0,1")}


def test_loads_copy_large_buckets_where_they_lie(spark, tmp_path, monkeypatch):
    """The same tables whether or not the rows that stay are dealt out again, and identifiers are sent to all tasks."""
    states = []
    for large, sent in ((1 << 30, 1_000_000), (0, 1_000_000), (0, 0)):
        monkeypatch.setattr(Store, "LARGE_MB", large)
        monkeypatch.setattr(Store, "SENT", sent)
        s = Store(spark, f"file://{tmp_path}/{large}-{sent}", buckets=2)
        s.load(*rows_of(spark, [f"d{i}" for i in range(12)], 1), 8)
        s.load(*rows_of(spark, ["d1", "d2", "new"], 2), 8)
        states.append(sorted(map(str, s.read("chunks").drop("embedding").collect())) + sorted(map(str, s.read("documents").drop("created_at").collect())))
    assert states[0] == states[1] == states[2] and len(states[0]) > 13
