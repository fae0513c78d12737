"""Substring dedup against plain code: copies, overlaps, hot passages, odd rows; and the count-min sketch alone."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corvane.llm import countmin, substrings
from corvane.llm.countmin import Sketch
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, width=20):
    """(n_words, n_removed, kept) of texts in order."""
    seen, out = set(), []
    for text in texts:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            if key in seen:
                gone[i : i + width] = [True] * width
            seen.add(key)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def corpus():
    r = random.Random(3)
    words = ["".join(r.choices("abcDé,.", k=r.randint(1, 5))) for _ in range(300)]
    passage = " ".join(r.choices(words, k=55))
    out = [None, "", " \t\n", "one", " ".join(words[:19]), " ".join(words[:20]), "\t".join(words[:20]) + "\n", "x " * 70, "y\x0by " * 30, "ﬀ ① 中 　 é " * 9]
    for _ in range(60):
        own = r.choices(words, k=r.randint(1, 200))
        cut = r.randrange(len(own) + 1)
        out.append(" ".join(own[:cut]) + " " + passage + "  " + " ".join(own[cut:]))
        if r.random() < 0.4:
            out.append(r.choice(["  ", "\n"]).join(own))
            out.append(" ".join(own).upper())
    out.append(" ".join(r.choices(words, k=30_000)) + " " + passage)
    out += [out[20]] * 25
    return out


def test_against_plain_code(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, unit string, place int").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substrings.substring_dedup(docs).collect()}
    want = {i: (n, gone, None if t is None else kept) for i, (t, (n, gone, kept)) in enumerate(zip(texts, brute(texts)))}
    assert got == want
    assert sum(gone for _, gone, _ in want.values()) > 3000


def test_other_widths_and_text_ids(spark):
    texts = ["a b c a b c", "c a b", "b c", "a b c d", ""]
    docs = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "name string, body string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substrings.substring_dedup(docs, "name", "body", width=2).collect()}
    assert got == {f"k{i}": x for i, x in enumerate(brute(texts, 2))}


def test_null_and_repeated_ids_and_equal_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(None, long), (None, long), (7, long), (7, long + " tail"), (3, None), (3, "short")]
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # null comes first, so one of its rows keeps the words
    assert got == Counter([(None, 40, 0), (None, 40, 40), (7, 40, 40), (7, 41, 40), (3, 0, 0), (3, 1, 0)])


def test_empty_table(spark):
    assert substrings.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("limit", [2, 100])
def test_a_sketch_never_misses_a_key(spark, limit):
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 3000, 20_000).astype(np.uint64) ** np.uint64(3) for _ in range(4)]
    sketch = Sketch.of(20_000, limit, 7)
    tables = []
    for unit, keys in enumerate(parts):
        if limit == 2:
            tables.append(sketch.requests(unit, keys))
        else:
            tables.append(sketch.requests(unit, *np.unique(keys, return_counts=True)))
    asked = spark.createDataFrame(pa.concat_tables(tables).to_pandas(), countmin.REQUEST)
    answers = sketch.answers(asked).toArrow()
    true = Counter(np.concatenate(parts).tolist())
    for unit, keys in enumerate(parts):
        over = sketch.reached(keys, answers.filter(pa.compute.equal(answers.column("unit"), unit)))
        real = np.array([true[k] >= limit for k in keys.tolist()])
        assert (over >= real).all()
        if limit == 100:
            assert (over & ~real).sum() == 0  # few keys in many cells: hardly any is taken for frequent


def test_units_are_ranges_in_order(spark):
    from corvane.llm.units import in_units

    docs = spark.createDataFrame([(i % 50, "t" * 3000) for i in range(400)], "doc_id long, text string").repartition(3)
    table, size = in_units(docs, [F.col("doc_id"), F.col("text")], [F.col("doc_id")], "ordered")
    rows = sorted((r["place"], r["unit"], r["doc_id"]) for r in table.select("place", "unit", "doc_id").collect())
    assert size == 400 * 3016 and len({p for p, _, _ in rows}) == 400
    assert [u for _, u, _ in rows] == sorted(u for _, u, _ in rows) and len({u for _, u, _ in rows}) > 1
    assert [d for _, _, d in rows] == sorted(d for _, _, d in rows)
