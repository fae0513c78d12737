"""Both jobs on copies of small tables: runs over growing input, runs again, deliveries that replace, odd rows, the command line."""

import json
import re
import shutil

import pytest
from corvane.functions import text as T
from corvane.functions.taxonomy import Taxonomy
from corvane.operators import chunking
from jobs import chunk_stream, watchlist
from jobs.queries import CHUNKS
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
OWN = Taxonomy(variables={"RATE": ("CRITICAL", ["rate"])}, sections={"DECISION": ["decided"]}, forward=["will"], boilerplate=["all rights reserved"])
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def delivered(spark, tmp_path, name, rows):
    """Writes one Parquet file into the source folder."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"file://{tmp_path}/new")
    (tmp_path / "source").mkdir(exist_ok=True)
    shutil.copy(next((tmp_path / "new").glob("part-*.parquet")), tmp_path / "source" / name)


def run(spark, tmp_path):
    return chunk_stream.run(spark, f"file://{tmp_path}/source", f"file://{tmp_path}/out", f"file://{tmp_path}/mark", taxonomy=OWN, chunks={"paragraph_break": "\n", "clean": False})


def state(spark, tmp_path):
    chunks, documents = chunk_stream.current(spark, f"file://{tmp_path}/out")
    return sorted(map(str, chunks.drop("batch").collect())), sorted(map(str, documents.drop("batch").collect()))


def test_chunk_stream_takes_only_what_is_new(spark, tmp_path):
    text = "The board decided that the rate will rise.\n" * 40
    delivered(spark, tmp_path, "a.parquet", [(1, text, "en", "s", 0), (2, "", "es", "s", 0), (3, None, None, None, None), (None, "nameless", "en", "s", 8)])
    assert run(spark, tmp_path) == 1
    chunks, documents = chunk_stream.current(spark, f"file://{tmp_path}/out")
    assert {(r["doc_id"], r["lang"], r["n_chunks"] > 0) for r in documents.collect()} == {(1, "en", True), (2, "es", False), (3, "und", False)}
    first = chunks.orderBy("position").first()
    assert (first["chunk_id"], first["section_type"], first["variables"]) == ("1_0000", "DECISION", ["RATE"]) and first["importance_score"] > 0.5 and "FORWARD_LOOKING" in first["tags"]

    before = state(spark, tmp_path)
    assert run(spark, tmp_path) == 0 and state(spark, tmp_path) == before  # nothing new

    # A new file: a new document, and one that is delivered again, twice within the file.
    delivered(spark, tmp_path, "b.parquet", [(2, "now with text", "es", "s", 0), (2, "the last one counts", "es", "s", 0), (4, "new", "de", "s", 0)])
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert run(spark, tmp_path) == 1
    assert all(p.stat().st_mtime_ns == t for p, t in written.items())  # what was written before stays as it is
    chunks, documents = chunk_stream.current(spark, f"file://{tmp_path}/out")
    assert {(r["doc_id"], r["text"]) for r in chunks.where("doc_id > 1").collect()} == {(2, "the last one counts"), (4, "new")}
    assert documents.count() == 4 and chunks.where("doc_id = 1").count() == len([x for x in before[0] if "doc_id=1" in x])

    # A delivery without text takes the chunks away.
    delivered(spark, tmp_path, "c.parquet", [(4, None, "de", "s", 0)])
    run(spark, tmp_path)
    chunks, documents = chunk_stream.current(spark, f"file://{tmp_path}/out")
    assert chunks.where("doc_id = 4").count() == 0 and documents.where("doc_id = 4").first()["n_chunks"] == 0


def test_a_failed_batch_runs_again_with_the_same_result(spark, tmp_path, monkeypatch):
    delivered(spark, tmp_path, "a.parquet", [(1, "one", "en", "s", 3), (2, "two", "es", "s", 3)])
    run(spark, tmp_path)
    delivered(spark, tmp_path, "b.parquet", [(1, "one again", "en", "s", 3), (3, "three", "en", "s", 3)])
    whole = chunk_stream._written

    def broken(*args):
        whole(*args)
        raise RuntimeError("after everything was written")

    monkeypatch.setattr(chunk_stream, "_written", broken)
    with pytest.raises(Exception, match="after everything"):
        run(spark, tmp_path)
    monkeypatch.setattr(chunk_stream, "_written", whole)
    assert run(spark, tmp_path) == 1
    chunks, documents = chunk_stream.current(spark, f"file://{tmp_path}/out")
    assert sorted((r["doc_id"], r["text"]) for r in chunks.collect()) == [(1, "one again"), (2, "two"), (3, "three")]
    assert documents.count() == 3


def test_a_batch_without_its_documents_is_not_read(spark, tmp_path):
    delivered(spark, tmp_path, "a.parquet", [(1, "one", "en", "s", 3)])
    run(spark, tmp_path)
    spark.createDataFrame([(9, "9_0000", 0, "half written")], "doc_id long, chunk_id string, position int, text string").write.parquet(f"file://{tmp_path}/out/chunks/batch=7/lang=en")
    assert [r["doc_id"] for r in chunk_stream.current(spark, f"file://{tmp_path}/out")[0].collect()] == [1]


def test_an_empty_source_and_a_folder_of_batches(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"file://{tmp_path}/source")
    run(spark, tmp_path)
    assert state(spark, tmp_path) == ([], [])


def test_a_chunk_carries_itself_only(spark):
    """Rows of one document, on their way to the enrichment, don't each hold all the document's chunks."""
    docs = spark.createDataFrame([(1, "some words\n" * 400, "en")], "doc_id long, text string, lang string")
    made = chunk_stream.enriched_chunks(docs, OWN, {"paragraph_break": "\n", "clean": False})
    plan = made._jdf.queryExecution().executedPlan().toString()
    (carried,) = re.findall(r"Generate posexplode\(chunks#\d+\), \[([^\]]*)\]", plan)
    assert "chunks#" not in carried and made.count() > 5


def test_white_space_is_what_patterns_take_for_it(spark):
    """stripped() and normalize_text() equal the plain patterns over every character, at both ends and between."""
    x = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    odd = [F.concat(x, F.lit("a"), x), F.concat(F.lit(" "), x), F.concat(F.lit("a "), x, F.lit(" b"), x, x, F.lit("c")), F.concat(F.lit("a"), x, F.lit("  b\t\n"))]
    codes = spark.range(1, 0x110000).where("id not between 55296 and 57343")
    same = [T.stripped(o).eqNullSafe(F.regexp_replace(o, r"(?U)^\s+|\s+$", "")) & T.normalize_text(o).eqNullSafe(F.trim(F.regexp_replace(T.strip_accents(F.lower(o)), r"(?U)\s+", " "))) for o in odd]
    assert codes.where(~(same[0] & same[1] & same[2] & same[3])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 300, 1000])
def test_folds_over_blocks_of_any_number(spark, n):
    """Chunks of a document with and without titles, against a loop."""
    for title in ("", "TITLE"):
        lines = [f"{title} A".strip() if title and i % 50 == 7 else f"line {i} " + "abc " * (i % 40) for i in range(n)]
        units, section = [], None
        for line in lines:
            line = line.strip()
            if title and line == f"{title} A":
                section = line
            elif line:
                units.append((line, section))
        want, text, size, own = [], None, 0, None
        for u, s in units:
            if size + len(u) > 600 and size >= 200:
                want.append((text.strip(), own))
                text, size, own = text[-100:], len(text[-100:]), s if s is not None else own
            else:
                own = own if own is not None else s
            text, size = u if text is None else f"{text} {u}", size + len(u) + 1
        want += [(text.strip(), own)] if text else []
        if len(want) > 1 and len(want[-1][0]) < 200:
            want[-2:] = [(f"{want[-2][0]} {want[-1][0]}", want[-2][1])]
        docs = spark.createDataFrame([(1, ["\n".join(lines)])], "id long, pages array<string>")
        got = chunking.chunk_documents(docs, "id", paragraph_break="\n", clean=False, longest=1 << 30).orderBy("position_in_doc").collect()
        assert [(r["text"], r["section_title_raw"]) for r in got] == want


QUERIES = [{"name": "words", "words": "the of"}, {"name": "like", "like": 3, "langs": ["en"]}, {"name": "both", "words": "de la", "like": 5}, {"name": "none", "words": "zzz"}, {"name": "gone", "like": 10**9}]


def test_watchlist_runs_again_and_leaves_other_lists(spark, tmp_path):
    out, before = f"file://{tmp_path}/hits", spark.sparkContext._jsc.getPersistentRDDs().size()
    paths = (f"{SF}/documents.parquet", f"{SF}/embeddings.parquet")
    found = watchlist.run(spark, *paths, out, queries=QUERIES, hits=5)
    rows = sorted(map(str, watchlist.read(spark, out).collect()))
    hits = watchlist.read(spark, out)
    assert found == hits.where("doc_id is not null").count() and {r["query"] for r in hits.where("doc_id is null").collect()} == {"none", "gone"}
    assert {(r["query"], r["rank"]) for r in hits.where("query in ('words', 'like', 'both')").collect()} == {(q, k) for q in ("words", "like", "both") for k in range(1, 6)}
    assert hits.where("query = 'like' and lang <> 'en'").count() == 0 and hits.where("query = 'like' and rank = 1").first()["vector_rank"] == 1
    watchlist.run(spark, *paths, out, queries=QUERIES, hits=5)
    assert sorted(map(str, watchlist.read(spark, out).collect())) == rows
    # Another list replaces its own partitions only; a query that finds nothing any more leaves no old hits.
    watchlist.run(spark, *paths, out, queries=[{"name": "words", "words": "zzz"}, {"name": "more", "words": "and"}], hits=2)
    after = watchlist.read(spark, out)
    assert after.where("query = 'words' and doc_id is not null").count() == 0 and after.where("query = 'more'").count() == 2
    assert sorted(map(str, after.where("query not in ('words', 'more')").collect())) == [r for r in rows if "query='words'" not in r]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC" and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_watchlist_refuses_lists_that_it_cannot_write():
    for bad in ([{"name": "a/b", "words": "x"}], [{"name": "a", "words": "x"}, {"name": "a", "words": "y"}], [{"name": "a"}]):
        with pytest.raises(ValueError, match="query|name"):
            watchlist.checked(bad)


def test_watchlist_over_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, None, None, None), (2, "", "en", "s"), (None, "the of", "en", "s"), (3, "the of", "en", "s"), (3, "the of", "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"file://{tmp_path}/d")
    spark.createDataFrame([(3, None), (2, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>").write.parquet(f"file://{tmp_path}/v")
    watchlist.run(spark, f"file://{tmp_path}/d", f"file://{tmp_path}/v", f"file://{tmp_path}/o", queries=[{"name": "q", "words": "the of", "like": 2}])
    assert 3 in {r["doc_id"] for r in watchlist.read(spark, f"file://{tmp_path}/o").collect()}


@pytest.mark.parametrize("job", ["chunk_stream", "watchlist"])
def test_command_lines(spark, tmp_path, monkeypatch, job):
    """The command lines make their own session; here they get this one, which they may not stop."""
    module = {"chunk_stream": chunk_stream, "watchlist": watchlist}[job]
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    if job == "chunk_stream":
        config = {"source": f"{SF}/documents.parquet", "output": f"file://{tmp_path}/o", "checkpoint": f"file://{tmp_path}/c"} | {k: CHUNKS[k] for k in ("chunks", "numbers", "taxonomy")}
    else:
        config = {"documents": f"{SF}/documents.parquet", "vectors": f"{SF}/embeddings.parquet", "output": "nowhere", "queries": QUERIES[:1]}
    (tmp_path / "config.json").write_text(json.dumps(config, indent=1))
    module.main([f"file://{tmp_path}/config.json", "--output", f"file://{tmp_path}/o"])
    if job == "chunk_stream":
        assert chunk_stream.current(spark, f"file://{tmp_path}/o")[1].count() == spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isNotNull()).count()
    else:
        assert watchlist.read(spark, f"file://{tmp_path}/o").count() == 10


@pytest.mark.parametrize("name", ["job1_chunk_stream", "job2_watchlist"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from jobs import queries

    own = duckdb.connect()
    for t in ("documents", "embeddings"):
        own.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found, table = queries.queries()[name](spark, SF), own.sql(queries.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(table.columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(repr, table.select(", ".join(columns)).fetchall()))
