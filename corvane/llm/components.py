"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import dropped, spread_join, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge in edges(a long, b long).

    component is the smallest node reachable. Each round every node takes the
    smallest label among its own, its neighbours' and its label's label, so
    long chains halve. Every round's labels are a written table; the driver
    only sees how many labels changed. An empty edge table gives no rows.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "component")
        best = labels.select("node", "component").union(near).groupBy("node").agg(F.min("component").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("lower"))
        large = labels.groupBy(F.col("component").alias("low")).agg(F.count("*").alias("n"))  # most of a large component has its label already
        new = written(
            spread_join(best, jump, ["low"], large).join(labels.withColumnRenamed("component", "old"), "node").select("node", F.least("low", F.coalesce("lower", "low")).alias("component"), "old"),
            "labels",
        )
        changed = new.where("component <> old").limit(1).count()
        dropped(labels)
        if not changed:
            dropped(both)
            return new.select("node", "component")
        path = new.corvane_path
        labels = new.select("node", "component")
        labels.corvane_path = path
