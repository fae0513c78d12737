"""Phrase collocations against plain code: pieces, overlaps, cuts, longer phrases, ties, languages, odd rows; suffix arrays alone."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from corvane.llm import collocations
from corvane.llm.suffixes import common_prefixes, ngrams, suffix_order

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def brute(rows, least, longest, top):
    """rows: (text, lang)."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = WORD.findall(piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in count.items():
        n = total[lang]
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        scored = []
        for p, a in frequent.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus():
    r = random.Random(7)
    words = ["a", "B", "the", "é", "É", "ß", "ﬁn", "x-y", "中", "q\x1cz", "long" * 9]
    rows = [(None, "en"), ("", "en"), (" .,;\n", None), ("A", "en"), ("a b", ""), ("The the THE the. the the!", "en")]
    for _ in range(300):
        own = r.choices(words, weights=range(len(words), 0, -1), k=r.randint(1, 60))
        gaps = [r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", " ! ", "\x0b"]) for _ in own]
        rows.append(("".join(w + g for w, g in zip(own, gaps)), r.choice(["en", "en", "de", None, ""])))
    rows += [("new york city hall is here. New York city hall", "en")] * 9
    return rows


def test_against_plain_code(spark):
    rows = corpus()
    docs = spark.createDataFrame([(t, x, "clash", 1) for t, x in rows], "text string, lang string, phrase string, n int").repartition(4)
    for least, longest, top in ((3, 5, 10_000), (9, 3, 7)):
        got = sorted(tuple(r) for r in collocations.collocations(docs, least=least, longest=longest, top=top).collect())
        assert got == brute(rows, least, longest, top)
        assert len(got) > 20


def test_high_thresholds_go_through_saturated_counts(spark):
    rows = [("red apple " * 200, "en"), ("red apple pie", "en")] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=400).collect())
    assert got == brute(rows, 400, 5, 2000)
    assert got


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    docs = spark.range(0, 64, 1, 8).select(F.lit("b b " * 40_000).alias("text"), F.lit(None).cast("string").alias("lang"))
    (row,) = collocations.collocations(docs, longest=2).collect()
    f, n = 64 * 79_999, 64 * 80_000
    assert tuple(row) == ("und", 1, "b b", f, n, n, n, 1000 * f * n // (n * n))


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_suffix_arrays_count_ngrams():
    r = random.Random(1)
    for _ in range(100):
        n = r.randint(0, 60)
        ids = np.array([r.randrange(3) for _ in range(n)], np.int64)
        left = np.ones(n, np.int8)
        for i in range(n - 2, -1, -1):
            left[i] = min(5, left[i + 1] + 1) if r.random() < 0.8 else 1
        order = suffix_order(ids, left, 5)
        prefixes = common_prefixes(ids, left, order, 5)
        for m in range(1, 6):
            _, first, sizes = ngrams(left, order, prefixes, m)
            got = {tuple(ids[i : i + m].tolist()): c for i, c in zip(first.tolist(), sizes.tolist())}
            assert len(got) == len(first)
            assert got == Counter(tuple(ids[i : i + m].tolist()) for i in range(n) if left[i] >= m)
