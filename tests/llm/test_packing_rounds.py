"""The configuration program places most sequences of every table, small ones too, and none needs more sequences than best fit."""

import random

import pytest
from corvane.llm import packing
from corvane.llm.queries import tokenizer_path

CAPACITY = 2048


def of_table(spark, sf):
    pieces = packing.token_pieces(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"), tokenizer_path("byte_bpe_50k.json"))
    return {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_tables(spark, sf):
    histogram = of_table(spark, sf)
    lone, program, tail = (sum(part.values()) for part in packing.solved(histogram, CAPACITY))
    best = len(packing._best_fit([n for n, k in histogram.items() for _ in range(k)], CAPACITY))
    assert lone + program + tail <= best
    assert program > 4 * tail


@pytest.mark.parametrize("seed", range(3))
def test_small_histograms_cover_exactly(seed):
    r = random.Random(seed)
    histogram = {r.randint(1, 100): r.randint(1, 4) for _ in range(r.choice([1, 3, 25]))}
    held: dict[int, int] = {}
    for times, pattern in packing.configurations(histogram, 100):
        assert sum(n * k for n, k in pattern.items()) <= 100
        for n, k in pattern.items():
            held[n] = held.get(n, 0) + times * k
    assert held == histogram
    assert packing.configurations({}, 100) == []
