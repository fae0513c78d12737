"""The forest alone: strings, descents, ascents and the share of rows that they look at."""

import numpy as np
import pytest
from corvane.llm import annforest
from corvane.llm.annforest import BITS, Forest, directions, shared, strings


def forest_of(x, ids=None):
    texts = strings(x)
    return Forest(np.arange(len(x)), np.arange(len(x)) if ids is None else ids, x, texts), texts


def test_strings_are_signs_of_products():
    x = np.random.default_rng(1).normal(size=(40, 20))
    texts = strings(x)
    for t in (0, 7):
        bits = (x / np.abs(x).max(axis=1, keepdims=True)).astype(np.float32) @ directions(20)[t] > 0
        assert [format(v, f"0{BITS}b") for v in texts[:, t].tolist()] == ["".join("01"[int(b)] for b in row) for row in bits]
    assert np.array_equal(strings(x * 7.5), texts)
    assert shared(np.array([0, 0, 1]), np.array([0, 1, 1 << (BITS - 1)])).tolist() == [BITS, BITS - 1, 0]


@pytest.mark.parametrize("share", [0.05, 0.4, 1.3, 2.5])
def test_an_ascent_finds_what_shares_the_prefix(share):
    x = np.random.default_rng(2).normal(size=(700, 32))
    forest, texts = forest_of(x)
    own = np.arange(0, 700, 35)
    level, last, begin, end = forest.stops(texts[own], share)
    asked = (end - begin).sum(axis=1)
    assert (level > 0).all() and (asked >= share * 700).all()
    for (at, root), q, d, t in zip(forest.candidates(own, texts[own], share), own, level, last):
        same = shared(texts, texts[q])
        need = d + (np.arange(len(texts[q])) > t)
        assert not root and set(at) == set(np.flatnonzero((same >= need).any(axis=1))) - {q}
        one_less = (same >= d + (np.arange(len(texts[q])) >= t)).sum()
        assert share * 700 <= (same >= need).sum()
        assert one_less < share * 700 or share < 0.1  # not a tree more than needed; its own row alone is 40 of the strings that share a prefix


def test_a_share_of_nothing_is_the_root_and_copies_are_found():
    x = np.concatenate([np.ones((300, 8)), np.random.default_rng(3).normal(size=(300, 8))])
    forest, texts = forest_of(x)
    (at, root), = forest.candidates(np.array([0]), texts[:1], float("inf"))
    assert root and len(at) == 599
    (at, root), = forest.candidates(np.array([0]), texts[:1], 0.01)
    assert not root and set(range(1, 300)) <= set(at)


@pytest.mark.parametrize(("sf", "blocks"), [("sf0.01", 4), ("sf0.1", 4), ("sf0.1", 24)])
def test_share_of_rows_looked_at_on_the_given_tables(spark, sf, blocks, capsys):
    """Neighbours come through prefixes: no query goes to the root. These vectors are close to isotropic, and a true neighbour's cosine is 0.27 and 0.33 on average, so much of the tables is looked at."""
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    texts, queries = strings(x), np.flatnonzero(ids % 20 == 0)
    deal = np.random.default_rng(4).permutation(len(x)) % blocks
    true = [set(o[o != q][:20].tolist()) for q in queries for o in [np.lexsort((ids, -(x @ x[q])))]]
    for share in annforest.LADDER:
        hit, looked, roots = 0, 0, 0
        for k in range(blocks):
            own = np.flatnonzero(deal == k)
            forest = Forest(own, ids[own], x[own], texts[own])
            for i, (at, root) in enumerate(forest.candidates(queries, texts[queries], share)):
                hit += len(set(own[at].tolist()) & true[i])
                looked += len(at)
                roots += root
        if hit >= annforest.RECALL * 20 * len(queries):
            break
    with capsys.disabled():
        print(f"\n{sf} in {blocks} blocks: {looked / len(x) / len(queries):.0%} of the rows looked at, {roots / blocks / len(queries):.0%} of the visits end at the root")
    assert looked < {"sf0.01": 0.85, "sf0.1": 0.75}[sf] * len(x) * len(queries) and roots < 0.1 * blocks * len(queries)


def test_clustered_vectors_need_few_rows():
    r = np.random.default_rng(5)
    x = (r.normal(size=(200, 64)).repeat(50, axis=0) + 0.2 * r.normal(size=(10_000, 64)))
    forest, texts = forest_of(x)
    queries = np.arange(0, 10_000, 200)
    hit = looked = 0
    for (at, _), q in zip(forest.candidates(queries, texts[queries], 0.15), queries):
        order = np.argsort(-(x @ x[q]), kind="stable")
        hit += len(set(at.tolist()) & set(order[order != q][:20].tolist()))
        looked += len(at)
    assert hit >= 0.95 * 20 * len(queries) and looked < 0.15 * 10_000 * len(queries)
