"""Order statistics by rounds of histograms, and models that a worker loads once."""

import random

import numpy as np
import pytest
from corvane.operators import embed, stats


@pytest.mark.parametrize("values", [[random.Random(1).gauss(0, 1e6) for _ in range(5000)], [2.0**k for k in range(-500, 500)], [7] * 900 + [8], [-5, -5, 3], [1], [10**15 + k for k in range(3000)], [0.1] * 10 + [1e300, -1e300]])
def test_positions_of_sorted_values(spark, values):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    kind = "double" if isinstance(values[0], float) else "long"
    row = stats.order_statistics(spark.createDataFrame([(v,) for v in [*values, None]], f"x {kind}").repartition(3), "x").first()
    s, n = sorted(values), len(values)
    assert tuple(row)[:6] == (s[0], s[n // 4], s[n // 2], s[3 * n // 4], s[9 * n // 10], s[-1])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_worker_loads_a_model_once(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        import os

        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda texts: (np.ones((len(texts), 2)), [1] * len(texts))

    rows = spark.range(400).selectExpr("id", "'x' AS embed_text").repartition(40)
    assert embed.with_vectors(rows, load, "m").count() == 400
    pids = open(log).read().split()
    assert 0 < len(pids) < 40 and len(pids) == len(set(pids))
