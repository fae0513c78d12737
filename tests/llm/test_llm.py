"""Each training-data operator against a brute-force version, a round trip or held-out labels, on small hostile tables."""

import json
import random
import re
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from corvane.llm import annforest, chat, eliasfano, exactdedup, jaccard, linededup, lm, lmtrie, packing, piecescan, quality, queries, sigtree, textnum, tokenbin
from corvane.llm.components import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts():
    """Copies, near copies, ties, nulls, empty and very long texts, white space of all kinds."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghé", k=r.randint(1, 8))) for _ in range(400)]
    passage = " ".join(r.choices(words, k=60))
    out = [None, "", " ", "\n\n", "a", "A", "a b c", "A  b\tC", "one two three four", "One two\nthree four", "x" * 5000, "é ß 中 　 ①\x1c"]
    for _ in range(25):
        own = r.choices(words, k=r.randint(3, 300))
        out.append(" ".join(own))
        for _ in range(r.randint(0, 4)):
            near = list(own)
            for _ in range(r.randint(0, max(1, len(own) // 40))):
                near[r.randrange(len(near))] = r.choice(words)
            out.append(" ".join(near).upper() if r.random() < 0.2 else " ".join(near))
        if r.random() < 0.5:
            out.append(" ".join(own[:40]) + " " + passage + " " + " ".join(own[40:]))
    out += ["same text of many copies, again and again " * 3] * 70
    out.append(" ".join(r.choices(words, k=20_000)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de"][i % 2], f"s{i % 13}", len(t or ""), f"clash{i}") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, token string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def brute_classes(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lowered(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    low = {i: i for i in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("width", "num", "den"), [(4, 85, 100), (5, 80, 100)])
def test_jaccard_is_exact(docs, width, num, den):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(docs, words=width, num=num, den=den).collect()}
    assert got == brute_classes(rows, width, num, den)


def test_jaccard_of_odd_tables(spark, empty):
    assert jaccard.jaccard_classes(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, None), (2, "a b c d e f"), (2, "a b c d e f"), (3, "A b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_classes(odd).collect())) == [(1, 0, 1), (2, 2, 2), (2, 2, 2), (3, 2, 2)]
    kept = jaccard.near_duplicate_stage(odd)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "a b c d e f"), (1, ""), (2, "a b c d e f"), (2, "a b c d e f")]


def test_pipeline_keeps_one_row_of_each_class(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    four, other, third = "a b c d e f", "g h i j k l m", "n o p q r s"
    rows = [(None, four), (2, four), (2, four), (3, four), (None, other), (None, other), (7, other + " "), (None, third), (None, third), (8, "t u v w x y"), (8, "z z z z z z y"), (9, None), (None, None), (9, None), (10, ""), (-4, four + " !")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(4)
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    kept = sorted(((str(r["doc_id"]), str(r["text"])) for r in out.collect()))
    assert kept == sorted([("-4", four + " !"), ("2", four), ("7", other + " "), ("None", third), ("8", "t u v w x y"), ("8", "z z z z z z y"), ("9", "None"), ("None", "None"), ("9", "None"), ("10", "")])
    plain = spark.createDataFrame([(5, four, "en", "s", 11), (4, four, "en", "s", 11), (6, other, "en", "s", 13)], schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, plain, SF).collect()) == [4, 6]
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), SF).count() == 0


@pytest.mark.parametrize("chunk", [3, 4096])
def test_block_pairs_of_all_widths_that_can_link(chunk):
    tokens = np.random.default_rng(4).integers(0, 1 << 63, 1100, dtype=np.uint64)
    sizes = [100, 128, 130, 300, 400, 700, 1100]
    sets = [np.sort(tokens[:k]) for k in sizes]
    bits = [sigtree.bitmap(s, sigtree.width_for(len(s))).tobytes() for s in sets]
    for num, den in ((10, 100), (30, 100), (50, 100), (80, 100)):
        wanted = {(i, j) for i in range(7) for j in range(i + 1, 7) if den * sizes[i] >= num * sizes[j]}
        found = set()
        for c1, c2 in ((0, 0), (1, 1), (0, 1)) if chunk == 3 else ((0, 0),):
            own = [i % 2 if chunk == 3 else 0 for i in range(7)]
            at = [i for i in range(7) if own[i] in (c1, c2)]
            rows = [{"own": own[i], "c1": c1, "c2": c2, "rep": i, "n": sizes[i], "component": i, "bits": bits[i]} for i in at]
            found |= set(map(tuple, jaccard._block_pairs(pa.Table.from_pylist(rows), num, den).tolist()))
        assert wanted <= found


def test_signature_trees_lose_no_pair():
    r = np.random.default_rng(3)
    base = [np.unique(r.integers(0, 1 << 63, r.integers(5, 60), dtype=np.uint64)) for _ in range(40)]
    sets = base + [np.unique(np.r_[b[r.random(len(b)) > 0.05], r.integers(0, 1 << 63, 2, dtype=np.uint64)]) for b in base for _ in range(4)]
    n, width = np.array([len(s) for s in sets]), 256
    maps = np.stack([sigtree.folded(sigtree.bitmap(s, sigtree.width_for(len(s))), width) for s in sets])
    classes = np.arange(len(sets)) // 3
    wanted = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if classes[i] != classes[j] and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    i, j = sigtree.dual_join(sigtree.SignatureTree(maps, n, classes), None, 80, 100)
    assert wanted <= set(zip(i.tolist(), j.tolist()))
    assert len(i) < len(sets) ** 2 / 8
    half = len(sets) // 2
    i, j = sigtree.dual_join(sigtree.SignatureTree(maps[:half], n[:half], classes[:half]), sigtree.SignatureTree(maps[half:], n[half:], classes[half:]), 80, 100)
    assert {p for p in wanted if p[0] < half <= p[1]} <= {(a, b + half) for a, b in zip(i.tolist(), j.tolist())}


def test_large_blocks_are_dealt_out_without_loss(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(docs, words=5).collect()}
    assert got == brute_classes(rows, 5, 80, 100)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    edges += [(1000, i) for i in range(1001, 3400)] + [(i, i + 1) for i in range(3400, 3410)] + [(3399, 3400)]  # a hub and a tail
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90} | {i: 1000 for i in range(1000, 3411)}


def test_spread_join_is_a_join(spark, monkeypatch):
    from corvane.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 2)
    r = random.Random(1)
    rows = spark.createDataFrame([(i, r.choice([1, 1, 1, 2, 2, 3, 4, None])) for i in range(200)], "id int, k int")
    other = spark.createDataFrame([(k, f"v{k}") for k in (1, 2, 3, 9)], "k int, v string")
    weights = rows.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        got = common.spread_join(rows, other, ["k"], weights, how)
        want = rows.join(other, ["k"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_words_and_shingles_match_plain_code():
    some = texts()
    words, first = textnum.hashed_words(pa.array(some))
    for t, a, b in zip(some, first[:-1], first[1:]):
        assert b - a == len(WORD.findall(lowered(t)))
    by_word = {}
    for t, a in zip(some, first[:-1]):
        for k, w in enumerate(WORD.findall(lowered(t))):
            assert by_word.setdefault(w, words[a + k]) == words[a + k]
    assert len(set(by_word.values())) == len(by_word)
    sliced = pa.array(["zz", *some, "yy"]).slice(1, len(some))
    assert all((x == y).all() for x, y in zip(textnum.shingle_sets(pa.array(some), 3), textnum.shingle_sets(sliced, 3)))


def test_exact_dedup(docs, spark, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    for r in exactdedup.exact_dedup(docs).collect():
        own = groups[lowered(dict(rows)[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(own), len(own), r["doc_id"] == max(own))
    assert exactdedup.exact_dedup(empty).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, "A"), (1, "A"), (None, None), (None, "")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exactdedup.exact_dedup(odd).collect())
    assert got == [("1", "1", 3, True), ("1", "1", 3, True), ("None", "1", 3, False), ("None", "None", 2, True), ("None", "None", 2, True)]


def test_exact_dedup_runs_no_python(docs):
    plan = exactdedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup(spark, empty):
    boiler = "All rights reserved by nobody"
    rows = [(i, f"own line {i}\n {boiler} \n\nshared {i // 3}\n{boiler}", f"s{i % 12}") for i in range(24)] + [(100, None, "s1"), (101, "", "s2"), (102, boiler, None)]
    out = {r["doc_id"]: r for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0]["text"] == f"own line 0\n {boiler} \n\nshared 0" and out[0]["n_removed"] == 1
    assert all(out[i]["text"] == f"own line {i}\n\nshared {i // 3}" and out[i]["n_removed"] == 2 and out[i]["n_lines"] == 5 for i in range(1, 24))
    assert out[100]["text"] is None and out[101]["text"] == "" and out[102]["text"] == ""
    few = spark.createDataFrame(rows[:9], "doc_id long, text string, source string")
    assert all(r["n_removed"] == 0 for r in linededup.line_dedup(few).collect())
    assert linededup.line_dedup(empty).count() == 0


@pytest.mark.parametrize("common", [linededup.COMMON, 0])
def test_line_dedup_against_plain_code(spark, monkeypatch, common):
    """Null and repeated ids, repeated rows, blank lines, null sites, clashing columns; lines broadcast and salted."""
    monkeypatch.setattr(linededup, "COMMON", common)
    r = random.Random(3)
    lines = [f"line {k}" for k in range(12)] + ["", "  ", " line 1\t", "only here"]
    rows = [(r.choice([None, *range(20)]), "\n".join(r.choices(lines, k=r.randint(0, 6))) if r.random() < 0.9 else None, r.choice([None, "a", "b", "c", "d"]), k, "x") for k in range(60)]
    rows += rows[:5]
    sites, first = {}, {}
    for i, t, s, *_ in rows:
        for pos, x in enumerate((t or "").split("\n")):
            if k := x.strip(" \t\r\x0b\f"):
                sites.setdefault(k, set()).update({s} - {None})
                first[k] = min(first.get(k, (99, 0)), (-1 if i is None else i, pos))
    want = []
    for i, t, s, n, x in rows:
        parts = [] if t is None else t.split("\n")
        keys = [p.strip(" \t\r\x0b\f") for p in parts]
        stays = [p for pos, (p, k) in enumerate(zip(parts, keys)) if not k or len(sites[k]) < 4 or first[k] == (-1 if i is None else i, pos)]
        want.append((i, None if t is None else "\n".join(stays), s, n, x, len(parts), len(parts) - len(stays)))
    out = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines long, N_Removed string").repartition(3), min_sites=4)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "N_Removed", "n_lines_", "n_removed_"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_near_the_limit_is_exact(spark):
    rows = [(n * 100 + s, f"line of {n}", f"site{s}") for n in range(1, 20) for s in range(n)]
    out = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=10)
    removed = {r["doc_id"] // 100: r["n"] for r in out.groupBy("doc_id").agg(F.sum("n_removed").alias("n")).groupBy(F.floor(F.col("doc_id") / 100).alias("doc_id")).agg(F.sum("n").alias("n")).withColumn("doc_id", F.col("doc_id") * 100).collect()}
    assert removed == {n: n - 1 if n >= 10 else 0 for n in range(1, 20)}


def test_pipeline_lines_go_from_few_sites(spark):
    import corpus_pipeline

    passage = {n: " ".join(f"planted{n}word{k}" for k in range(55)) for n in range(1, 10)}
    rows = [(100 * n + k, f"own text of {n} and {k}\n{passage[n]}", f"site{k % n}") for n in passage for k in range(9)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r for r in corpus_pipeline.lines(spark, docs, SF).collect()}
    for i, t, _ in rows:
        stays = i // 100 < 3 or i % 100 == 0
        assert out[i]["text"] == (t if stays else t.split("\n")[0]) and out[i]["n_chars"] == len(out[i]["text"])


def test_quality_learns_and_ignores_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels).join(labels, "doc_id")
    held = [(r["score"], r["quality"]) for r in out.where("held_out").collect()]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    shuffled = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality.classify(docs, shuffled).collect())) == sorted(map(tuple, quality.classify(docs, labels).collect()))


def test_quality_of_odd_tables(docs, spark, empty):
    labels = spark.createDataFrame([(0, 1), (None, 0), (3, None)], "doc_id long, quality int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert quality.classify(empty, labels).count() == 0
    kept = quality.good_documents(docs, quality.fit(np.zeros((0, 31)), np.zeros(0)), threshold=0.4)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def _plain_statistics(t):
    data = (t or "").encode()
    sets = {"control": bytes(range(32)), "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789", "space": b" ", "newline": b"\n\r", "tab": b"\t", "full stop": b".", "comma": b",;:", "bang": b"!", "question": b"?", "quote": b"'\"`", "bracket": b"()[]{}", "markup": b"<>/\\=_|", "dash": b"-", "high": bytes(range(128, 256))}
    kind = {}
    for name, some in sets.items():
        kind |= dict.fromkeys(some, name)
    kinds = Counter(kind.get(b, "symbol") for b in data)
    n = max(len(data), 1)
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    small = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    lines = (data[:-1] if data.endswith(b"\n") else data).split(b"\n") if data else []
    per, shares = max(len(words), 1), [data.count(bytes([b])) / n for b in set(data)]
    upper = [len(w) > 0 and 65 <= w[0] <= 90 and 65 <= w[min(1, len(w) - 1)] <= 90 for w in words]
    ends = [kind.get(w[-1], "symbol") in ("symbol", "markup", "bang") for w in words]
    return [
        *(kinds[c] / n for c in quality._CLASSES), np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / per, min(max(map(len, words), default=0), 1000), len(data) / max(len(lines), 1),
        len(set(small)) / per, len(set(zip(small, small[1:]))) / max(len(words) - 1, 1), len({x + b"\n" if k < len(lines) - 1 or data.endswith(b"\n") else x for k, x in enumerate(lines)}) / max(len(lines), 1),
        sum(len(w) <= 3 for w in words) / per, sum(upper) / per, sum(ends) / per, max(shares, default=0), -sum(x * np.log2(x) for x in shares),
    ]


@pytest.mark.parametrize("window", [textnum.WINDOW, 50])
def test_statistics_match_plain_code(monkeypatch, window):
    monkeypatch.setattr(textnum, "WINDOW", window)
    monkeypatch.setattr(textnum, "_powers", [])
    monkeypatch.setattr(quality, "WINDOW", window)
    r = random.Random(11)
    some = texts()[:70] + ["".join(r.choices("aB1 .,;!?'\"()<>=_-\t\n\r~§é中", k=r.randint(1, 120))) for _ in range(80)] + ["one line\n", "A\nA\n", "AB Cd E"]
    got = quality.statistics(pa.array(some))
    assert np.abs(got - np.array([_plain_statistics(t) for t in some])).max() < 1e-4
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def test_flat_trees_follow_plain_traversal():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5)).astype(np.float32)
    trees = quality.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float), trees=20, depth=3)
    for i in range(0, 400, 37):
        total = trees.base
        for t in range(20):
            at = 0
            while at < 7:
                at = 2 * at + 1 + int(x[i, trees.statistic[t, at]] > trees.border[t, at])
            total += trees.leaf[t, at - 7]
        assert abs(trees.score(x[i : i + 1])[0] - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((trees.score(x) > 0.5) == ((x[:, 0] > 0) ^ (x[:, 1] > 0.3))).mean() > 0.95


def _scan(p, text, chunk):
    m, around = p.marked(text), 2 * p.longest + 2
    rows = [{"text": m[max(0, a - around) : a + chunk + around], "begin": a - max(0, a - around), "tail": a + chunk + around >= len(m)} for a in range(0, len(m), chunk)]
    parts = [piecescan._chunk_of(p, r, chunk) for r in rows]
    path = piecescan.boundary_states([c.matrix() for c in parts])
    return b"".join(c.trace(i, o) for c, i, o in zip(parts, path, path[1:]))


def test_piece_scan_gives_the_library_s_ids():
    p = piecescan.pieces_of(queries.tokenizer_path("piece_bpe_32k.model"))
    assert not [t for t in p.ids if re.search(f"[^{piecescan.MARK}]{piecescan.MARK}", t)]
    r = random.Random(2)
    some = [t for t in texts()[:60] if t]
    some += ["".join(r.choices("abcdeinstr ▁\n①é", k=r.randint(1, 90))) for _ in range(150)] + ["".join(r.choices("abcdeinrst", k=300)) for _ in range(10)]
    for t in some:
        t = t[:3000]
        want = np.array(p.model.encode(t), "<u4").tobytes()
        assert p.encode(t) == want
        for chunk in (13, 64):
            assert len(t) > 1500 or _scan(p, t, chunk) == want


def test_products_are_associative():
    r = np.random.default_rng(0)
    a, b, c = (np.where(r.random((4, 4)) < 0.4, -np.inf, r.integers(-9, 9, (4, 4)).astype(float)) for _ in range(3))
    assert (piecescan.product(piecescan.product(a, b), c) == piecescan.product(a, piecescan.product(b, c))).all()


def test_paths_within_blocks():
    """The path by blocks is the path over all chunks."""
    r = np.random.default_rng(4)
    for _ in range(30):
        sizes = [1, *r.integers(1, 5, 11), 3]
        chain = [np.where(r.random((a, b)) < 0.2, -np.inf, r.normal(size=(a, b))) for a, b in zip(sizes, sizes[1:])]
        whole = piecescan.boundary_states(chain)
        cut = [chain[i : i + 5] for i in range(0, len(chain), 5)]
        borders = piecescan.boundary_states([piecescan.whole_product(c) for c in cut])
        path = [borders[0]]
        for c, i, o in zip(cut, borders, borders[1:]):
            path += piecescan.boundary_states(c, i, o)[1:]
        if np.isfinite(piecescan.whole_product(chain)).any():
            assert path == whole


def test_repeated_and_missing_ids_are_kept_apart(spark):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    p = piecescan.pieces_of(path)
    some = ["uno dos tres " * 300, "otro texto largo " * 260, None, "", "corto"]
    rows = [(i, t, "clash") for i in (None, 1, 1) for t in some]
    got = sorted((str(r["doc_id"]), bytes(r["ids"])) for r in piecescan.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids string"), path, chunk=50).collect())
    assert got == sorted((str(i), np.array(p.model.encode(t or ""), "<u4").tobytes()) for i, t, _ in rows)


def test_pieces_of_documents(docs, empty):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    p = piecescan.pieces_of(path)
    whole = dict((r["doc_id"], r["text"] or "") for r in docs.collect())
    out = piecescan.encode_documents(docs, path, chunk=700)
    got = {r["doc_id"]: bytes(r["ids"]) for r in out.collect()}
    assert got == {i: np.array(p.model.encode(t), "<u4").tobytes() for i, t in whole.items()}
    back = {r["doc_id"]: r["text"] for r in piecescan.decode_documents(out, path).collect()}
    assert back == {i: p.model.decode(p.model.encode(t)) for i, t in whole.items()}
    assert piecescan.encoded_report(empty, path).count() == 0


def test_packing(docs, empty):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rows = packing.packed_documents(docs, path, capacity=128).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for d in docs.collect():
        ids = [*plain.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == crc32(np.array(part, "<u4").tobytes()) and (r["length"] == 128 or r["piece"] == 0)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))] and sum(r["length"] for r in own) <= 128
    assert packing.packed_documents(empty, path).count() == 0


def test_added_tokens_are_the_library_s(spark, tmp_path):
    from corvane.llm import bpememo
    from tokenizers import AddedToken, Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    r = random.Random(8)
    some = [None, "", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>", "<|endoftext|><|endoftext|> \n", "<|endoftext", "no token here"]
    some += ["".join(r.choices(["<|endoftext|>", " ", "\n", "word", "Über", "!", "  "], k=r.randint(1, 12))) for _ in range(200)]
    plain.add_tokens([AddedToken("two words", lstrip=True, rstrip=True), AddedToken("abc", single_word=True)])
    plain.save(str(tmp_path / "more.json"))
    for name, texts_ in ((path, some), (str(tmp_path / "more.json"), [*some, "so two words  here", "abc abcd, abc."])):
        default = Tokenizer.from_file(name)
        want = [default.encode(t or "", add_special_tokens=False).ids for t in texts_]
        assert [np.frombuffer(b, "<u4").tolist() for b in bpememo.MemoEncoder(name).encode(texts_)] == want
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    default = Tokenizer.from_file(path)
    ids = {i: default.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(some)}
    crc = lambda x: crc32(np.array(x, "<u4").tobytes())
    assert {r["doc_id"]: r["ids_crc32"] for r in packing.packed_documents(docs, path).collect()} == {i: crc([*x, 0]) for i, x in ids.items()}
    assert {r["doc_id"]: r["ids_crc32"] for r in tokenbin.token_files(docs, path).collect()} == {i: crc([*x, 2]) for i, x in ids.items()}


@pytest.mark.parametrize("seed", range(6))
def test_configurations_cover_exactly(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 50, 300])
    histogram = {n: r.randint(1, 200) for n in r.sample(range(1, capacity + 1), r.randint(1, min(capacity, 40)))}
    patterns = packing.configurations(histogram, capacity, steps=60)
    covered = Counter()
    for times, p in patterns:
        assert sum(n * k for n, k in p.items()) <= capacity
        for n, k in p.items():
            covered[n] += times * k
    assert covered == histogram
    best = len(packing._best_fit([n for n, k in histogram.items() for _ in range(k)], capacity))
    assert sum(t for t, _ in patterns) <= best * 1.05 + 1


@pytest.mark.parametrize(("fold", "steps"), [(1, packing.STEPS), (30, 60)])
def test_sequences_come_from_the_program(fold, steps):
    import duckdb
    from corvane.llm.bpememo import MemoEncoder

    encoder = MemoEncoder(queries.tokenizer_path("byte_bpe_50k.json"))
    sizes = [len(b) // 4 + 1 for b in encoder.encode([t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet'").fetchall()])]
    histogram = Counter()
    for n in sizes:
        histogram[2048] += n // 2048 * fold
        histogram[n % 2048] += fold
    del histogram[0]
    lone, program, tail = (sum(part.values()) for part in packing.solved(histogram, 2048, steps))
    assert program > 4 * tail and program > 0.85 * (program + tail)
    assert lone + program + tail <= -(-sum(n * k for n, k in histogram.items()) // 2048) * 1.0005


def test_pieces_keep_their_other_columns(spark):
    rows = [(None, 0, 0, 3, 9, "x", 1.5, 7), (None, 0, 0, 3, 9, "x", 1.5, 7), (1, 0, 0, 5, 2, "y", None, 8), (2, 0, 0, 2, 4, None, 2.5, 9)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, deal string, rank double, own int")
    out = packing.pack(pieces, capacity=8)
    assert out.columns == [*pieces.columns, "sequence_id", "offset"]
    got = out.collect()
    assert sorted(map(str, (tuple(r)[:8] for r in got))) == sorted(map(str, rows)) and len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert len({r["sequence_id"] for r in got}) == 2


def test_nearest_reaches_its_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = rows.collect()
    ids, x = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], float)
    hit = total = 0
    got = {}
    for r in annforest.nearest(rows).collect():
        got.setdefault(r["query_id"], []).append(r)
    for q in [i for i in ids if i % 20 == 0]:
        at = int(np.flatnonzero(ids == q)[0])
        score = x @ x[at]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        own = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(r["score"], -r["vec_id"]) for r in own] == sorted([(r["score"], -r["vec_id"]) for r in own], reverse=True)
        hit += len({r["vec_id"] for r in own} & set(ids[order]))
        total += 20
    assert hit / total >= 0.9


def test_nearest_of_odd_tables(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(100, [0.0, 1.0]), (101, None), (102, [0.0, 0.0]), (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (120, [1.0, None]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {}
    for r in annforest.nearest(df).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(out) == {0, 20, 40, 100}
    assert sorted(out[20]) == [(k + 1, v, 1.0) for k, v in enumerate([x for x in range(50) if x != 20][:20])]
    assert sorted(out[100])[0] == (1, 0, 0.0)
    few = annforest.nearest(df.where("vec_id in (0, 1, 2)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1, 1), (0, 2, 2)]
    assert annforest.nearest(df.where("vec_id < 0")).count() == 0


def test_nearest_of_repeated_rows(spark):
    """Every row but the query's own is a candidate; every row with a query's id is a query."""
    r = np.random.default_rng(6)
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (7, [2.0, 0.5]), (8, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((x["rank"], x["vec_id"], x["score"]) for x in annforest.nearest(df).collect())
    assert got == [(1, 7, 2.0), (2, 7, 1.0), (3, 7, 1.0), (4, 8, 0.5)]
    many = [(int(i), [float(x) for x in v]) for i, v in zip(r.integers(0, 60, 300), r.normal(size=(300, 8)).round(2))] + [(20, [1.0] * 8)] * 30 + [(40, [0.5] * 8)] * 2
    out = {}
    for x in annforest.nearest(spark.createDataFrame(many, "vec_id long, embedding array<float>").repartition(5), recall=1.0).collect():
        out.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    f = np.array([v for _, v in many], np.float32).astype(float)
    for q in (0, 20, 40):
        want = []
        for i in [i for i, (v, _) in enumerate(many) if v == q]:
            score = (f * f[i]).sum(axis=1)
            order = [j for j in sorted(range(len(many)), key=lambda j: (-score[j], many[j][0])) if j != i][:20]
            want += [(n + 1, many[j][0], score[j]) for n, j in enumerate(order)]
        assert sorted(out[q]) == sorted(want)


def test_nearest_beyond_the_ladder_looks_at_all_rows(spark, monkeypatch):
    monkeypatch.setattr(annforest, "LADDER", (0.0,))
    r = np.random.default_rng(9)
    x = r.normal(size=(200, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(a["query_id"], a["rank"]): a["vec_id"] for a in annforest.nearest(df, recall=1.0).collect()}
    for q in range(0, 200, 20):
        order = [j for j in np.argsort(-(x @ x[q]), kind="stable") if j != q][:20]
        assert [got[q, k + 1] for k in range(20)] == order


def test_chat_links_calls(spark):
    schema = {"sum": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "number", "maximum": 9}}, "required": ["a"], "additionalProperties": False}}
    call = lambda i, **a: f"<tool_call>{json.dumps({'id': i, 'name': 'sum', 'arguments': a})}</tool_call>"
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "tool", json.dumps({"tool_call_id": "c1", "content": {"z": 1.0, "a": "é"}})),
        (1, 2, "assistant", "first " + call("c1", a=1)),
        (1, 3, "assistant", call("c2", a="x", b=10, q=1)),
        (1, 4, "tool", json.dumps({"tool_call_id": "nope", "content": "?"})),
        (2, 0, None, None),
        (2, 0, None, None),
        (3, 0, "assistant", "<tool_call>not json</tool_call>"),
        (None, 0, "user", "x"),
    ]
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), schema).collect()}
    one = json.loads(out[1]["text"])
    assert [m["role"] for m in one] == ["user", "assistant", "tool", "assistant", "tool"]
    assert one[2] == {"role": "tool", "tool_call_id": "c1", "name": "sum", "content": '{"a":"é","z":1}'}
    assert (out[1]["n_calls"], out[1]["n_linked"]) == (2, 1)
    assert set(out[1]["problems"]) == {"c2: $.a: not of type integer", "c2: $.b: over the maximum", "c2: $.q: not allowed", "nope: result without a call"}
    assert out[2]["text"] == '[{"content":"","role":""},{"content":"","role":""}]' and out[3]["n_calls"] == 0 and len(out) == 4


HOSTILE = {
    "not finite": '{"tool_call_id": "a", "content": {"x": NaN}}',
    "too large": '{"tool_call_id": "a", "content": 1e999}',
    "surrogate": '{"tool_call_id": "a", "content": ["\\ud800"]}',
    "surrogate id": '{"tool_call_id": "\\ud800", "content": 1}',
    "deep": '{"tool_call_id": "a", "content": ' + "[" * 50_000 + "]" * 50_000 + "}",
    "rather deep": '{"tool_call_id": "a", "content": ' + "[" * 150 + "]" * 150 + "}",
    "long number": '{"tool_call_id": "a", "content": ' + "9" * 5000 + "}",
}


def test_chat_survives_hostile_output(spark):
    schema = {"f": {"type": "object", "properties": {"n": {"type": "integer", "maximum": 5}}}}
    rows = [(i, 0, "tool", t) for i, t in enumerate(HOSTILE.values())]
    rows += [(100 + i, 0, "assistant", f"<tool_call>{json.dumps({'id': 'a', 'name': 'f'})[:-1]}, \"arguments\": {t}}}</tool_call>") for i, t in enumerate(HOSTILE.values())]
    rows += [(200, 0, "assistant", '<tool_call>{"id": [1.0], "name": "f", "arguments": {"n": ' + "9" * 400 + "}}</tool_call>"), (200, 1, "tool", '{"tool_call_id": [1], "content": ' + "9" * 400 + "}")]
    rows += [(300, 0, "user", "long " * 300_000), (300, 1, None, None), (300, None, "x", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_chats(frame.withColumn("ids", F.lit("clash")), schema).collect()}
    for i, t in enumerate(HOSTILE.values()):
        assert json.loads(out[i]["text"]) == [{"role": "tool", "content": t}] and out[i]["problems"] == []
        whole = json.loads(out[100 + i]["text"])
        assert whole == [{"role": "assistant", "content": rows[len(HOSTILE) + i][3]}] and out[100 + i]["n_calls"] == 0
    assert out[200]["n_linked"] == 1 and out[200]["problems"] == ["[1]: $.n: over the maximum"] and "9" * 400 in out[200]["text"]
    assert [m["role"] for m in json.loads(out[300]["text"])] == ["x", "user", ""] and out[300]["n_turns"] == 3
    assert chat.format_chats(frame.where("false"), schema).count() == 0


def test_topological_order_breaks_cycles():
    assert chat.ordered([{"ids": ["a"], "after": ["b"]}, {"ids": ["b"], "after": ["a"]}, {"after": ["c"]}, {"ids": ["c"]}]) == [3, 2, 0, 1]


@pytest.mark.parametrize(("n", "top"), [(0, 9), (1, 0), (1, (1 << 64) - 1), (900, 50), (3000, 10**12), (2000, (1 << 64) - 1)])
def test_elias_fano(n, top):
    r = np.random.default_rng(n)
    v = np.sort(r.integers(0, top, n, dtype=np.uint64, endpoint=True))
    e = eliasfano.EliasFano(eliasfano.encoded(v, top))
    assert (e.all() == v).all() and e.end == len(eliasfano.encoded(v, top))
    if n:
        at = r.integers(0, n, 200)
        assert (e.select(at) == v[at]).all()
        wanted = np.sort(np.r_[v[at], r.integers(0, top, 200, dtype=np.uint64, endpoint=True)])
        found = lmtrie.find(e, wanted)
        assert ((found >= 0) == np.isin(wanted, v)).all() and (v[found[found >= 0]] == wanted[found >= 0]).all()
        strict = np.unique(v)
        e = eliasfano.EliasFano(eliasfano.encoded(strict, top))
        for low, high in ((0, len(strict)), np.sort(r.integers(0, len(strict) + 1, 2))):
            place, same = e.successors(wanted, np.full(len(wanted), low), np.full(len(wanted), high))
            want = np.clip(np.searchsorted(strict, wanted), low, high)
            assert (place == want).all() and (same == [k < high and strict[k] == w for k, w in zip(want, wanted)]).all()


def _plain_model(learned, order):
    """Interpolated absolute discounting, by dictionaries."""
    uni = Counter(w for own in learned for w in own)
    n_all, v = sum(uni.values()), len(uni)
    counts, total, kinds = Counter(), Counter(), Counter()
    for own in learned:
        for i, w in enumerate(own):
            before = ["<s>"] * order + own[:i]
            for k in range(1, order):
                counts[tuple(before[-k:]), w] += 1
    for (c, _), n in counts.items():
        total[c] += n
        kinds[c] += 1

    def p(context, w):
        if not context:
            return (uni[w] + 1) / (n_all + v + 1)
        lower = p(context[1:], w)
        if not total[context]:
            return lower
        weight = 0.75 * kinds[context] / total[context]
        n = counts[context, w]
        # Where a gram wasn't seen, weights multiply; where it was, lower orders are added.
        return max(n - 0.75, 0) / total[context] + weight * lower

    return uni, n_all, v, p


@pytest.mark.parametrize(("order", "share"), [(3, None), (2, None), (4, None), (3, 0.0)])
def test_lm_scores(docs, spark, empty, monkeypatch, order, share):
    monkeypatch.setattr(lm, "GATHERED", 5000)
    if share is not None:  # every word is a very frequent one
        monkeypatch.setattr(lm, "FREQUENT", 10**6)
        counted = lm._vocabulary

        def all_frequent(rows, order, folder):
            m = counted(rows, order, folder)
            m.frequent = np.arange(0, m.words, 3, dtype=np.uint64)
            return m

        monkeypatch.setattr(lm, "_vocabulary", all_frequent)
    odd = spark.createDataFrame([(None, "a b c a b c", 0), (None, None, 0), (5, "again again again again", 0), (5, "again again again again", 0)], "doc_id long, text string, token int")
    table = docs.select("doc_id", "text", "token").unionByName(odd.withColumn("token", F.col("token").cast("string")))
    rows = [(r["doc_id"], [*WORD.findall(lowered(r["text"])), None]) for r in table.collect()]
    held = lambda i: i is not None and crc32(str(i).encode()) % 7 == 2
    uni, n_all, v, p = _plain_model([w for i, w in rows if not held(i)], order)
    want = []
    for i, own in rows:
        padded = ["<s>"] * (order - 1) + own
        exact = sum(log10(p(tuple(padded[k : k + order - 1]), w)) for k, w in enumerate(own))
        want.append((i, held(i), len(own), sum(uni[w] > 0 for w in own), n_all, sum(log10((uni[w] + 1) / (n_all + v + 1)) for w in own), exact))
    key = lambda r: (str(r[0]), r[2], r[5])
    got = [tuple(r) for r in lm.train_and_score(table, order=order).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * g[2]
        assert abs(g[6] - w[6]) < 0.01 * g[2]
    assert abs(sum(g[6] for g in got) - sum(w[6] for w in want)) < 0.001 * sum(g[2] for g in got)
    assert lm.train_and_score(empty).count() == 0
    assert lm.train_and_score(docs.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_lm_shards_follow_the_tokens(spark, monkeypatch, order):
    """Many more shards than partitions, a word and a pair that are a third of all tokens, and shards asked by several tasks."""
    r = np.random.default_rng(5)
    texts = [" ".join(["hot"] * int(r.integers(0, 40)) + [f"w{int(i)}" for i in r.zipf(1.3, 60) % 400]) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    uni, n_all, v, p = _plain_model([[*t.split(), None] for t in texts], order)
    monkeypatch.setattr(lm, "TOKENS_A_SHARD", 300)
    model = lm.train(docs, order=order)
    assert model.tokens == n_all and model.words == v and model.shards == -(-n_all // 300) > 1 << model.word_bits
    if order > 2:
        assert uni["hot"] * model.shards // n_all in (max(model.widths.values()), max(model.widths.values()) - 1) and len(model.begins) == len(model.frequent) + 1
    assert max(model.askers.values()) > 2
    got = {r["doc_id"]: (r["n_tokens"], r["score"]) for r in lm.score(docs, model).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = [*t.split(), None]
        padded = ["<s>"] * (order - 1) + own
        want = sum(log10(p(tuple(padded[k : k + order - 1]), w)) for k, w in enumerate(own))
        assert got[i][0] == len(own) and abs(got[i][1] - want) < 0.01 * len(own)


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_codes(n):
    values = np.random.default_rng(n).uniform(-7, 0, n)
    held = lmtrie.Codes(lmtrie.Codes.made(values), 0, n)
    assert n == 0 or np.abs(held[np.arange(n)] - values).max() <= (values.max() - values.min()) / 2046 + 1e-9


def test_packed_columns():
    r = np.random.default_rng(2)
    for n in (0, 1, 1000):
        columns = [np.sort(r.integers(0, 1 << 63, n, dtype=np.uint64)), r.integers(0, 300, n, dtype=np.uint64), np.zeros(n, np.uint64)]
        assert all((a == b).all() for a, b in zip(lm.unpacked(lm.packed(columns)), columns))
    wide = [r.integers(0, 1 << 40, 500, dtype=np.uint64) for _ in range(3)]
    for columns in (wide, [c % np.uint64(4) for c in wide]):
        rows, n = lm._sums(columns, None)
        want = Counter(zip(*(c.tolist() for c in columns)))
        assert dict(zip(zip(*(c.tolist() for c in rows)), n.tolist())) == want


def test_token_files(docs, spark, empty, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    start, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    out = tokenbin.token_files(docs, path, f"file://{tmp_path}/shards")
    assert sorted(tuple(r)[:4] for r in out.collect()) == want
    shard = tokenbin.Shard(f"{tmp_path}/shards/000000.tok")
    assert shard.document(0).tolist()[-1] == 2 and shard.id_bytes == 2
    assert tokenbin.token_files(empty, path).count() == 0
    odd = spark.createDataFrame([(None, "b"), (1, "x"), (1, "y")], "doc_id long, text string")
    assert [r["doc_id"] for r in sorted(tokenbin.token_files(odd, path).collect(), key=lambda r: r["start"])] == [None, 1, 1]


def test_pipeline_stages_of_odd_tables(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, n_removed int, token long, rank int, `a.b` int"
    words = " ".join(f"w{k}" for k in range(400))
    rows = [(None, None, None, None, None), (None, "", None, "s1", 0), (1, None, "en", None, None), (2, words, "en", "s1", len(words)), (2, words, "en", "s1", len(words)), (3, words + "\n" + words, "en", "s2", None), (4, "x " * 300_000, None, "s3", 600_000)]
    docs = spark.createDataFrame([(*r, "n", 7, 1, 2, 3) for r in rows], schema).repartition(3)
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == docs.columns, name
            own = out.collect()
            assert len(own) <= len(rows) and all(tuple(r)[5:] == ("n", 7, 1, 2, 3) for r in own)
        packed = corpus_pipeline.packing(spark, table, SF).collect()
        assert sum(r["piece"] == 0 for r in packed) == (len(rows) if table is docs else 0)


def test_pipeline_against_plain_code(spark):
    """Each stage of the pipeline recomputed from its predecessor's rows, and the whole run's rows from the last."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = {c: i for i, c in enumerate(docs.columns)}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    x = np.array([_plain_statistics(r[at["text"]]) for r in rows], np.float32)
    rows = [r for r, p in zip(rows, model.score(x)) if p >= 0.3]
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, rows))

    sites, first = {}, {}
    strip = lambda t: t.strip(" \t\r\x0b\f")
    for r in rows:
        for pos, line in enumerate((r[at["text"]] or "").split("\n")):
            if k := strip(line):
                sites.setdefault(k, set()).update({r[at["source"]]} - {None})
                first[k] = min(first.get(k, (1 << 60, 0)), (r[at["doc_id"]], pos))
    cleaned = []
    for r in rows:
        parts = (r[at["text"]] or "").split("\n")
        stays = [p for pos, p in enumerate(parts) if not strip(p) or len(sites[strip(p)]) < 3 or first[strip(p)] == (r[at["doc_id"]], pos)]
        own = list(r)
        if len(stays) < len(parts):
            own[at["text"]] = "\n".join(stays)
            own[at["n_chars"]] = len(own[at["text"]])
        cleaned.append(tuple(own))
    kept = corpus_pipeline.lines(spark, kept, SF)
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, cleaned))

    classes = brute_classes([(r[at["doc_id"]], r[at["text"]]) for r in cleaned], 5, 80, 100)
    single = [r for r in cleaned if classes[r[at["doc_id"]]][1] == r[at["doc_id"]]]
    kept = corpus_pipeline.near_duplicates(spark, kept, SF)
    assert len(single) < len(cleaned) and sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, single))

    plain = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want = set()
    for r in single:
        ids = [*plain.encode(r[at["text"]] or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(min(head, len(ids)), len(ids) + 1, 2048)]
        want |= {(r[at["doc_id"]], k, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {tuple(r)[:5] for r in out} == want and len(out) == len(want)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    total = sum(r["length"] for r in out)
    assert len(by_sequence) <= -(-total // 2048) + 2


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        now = {r["doc_id"] for r in docs.collect()}
        assert now <= kept and (name != "lines" or now == kept)
        kept = now
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert packed == kept
