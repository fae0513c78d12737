"""Rows in order, dealt into units of bounded size, in a table that is bucketed by unit."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import new_path, partitions, transient

#: Text bytes of a unit, about; a longer text has a unit with others of its neighbourhood. Tables with less than so many for each task have smaller ones.
UNIT_BYTES, LEAST_BYTES = 4 << 20, 64 << 10


def in_units(docs: DataFrame, columns: list[Column], order: list[Column], name: str, unit_bytes: int = UNIT_BYTES) -> tuple[DataFrame, int]:
    """(unit int, place long, columns), and the number of bytes in the column text, which columns must hold.

    Units are ranges of the rows in that order, ties in any order; place ascends with it through all units. The
    table is bucketed by unit, so grouping by unit moves no texts. Files go when the driver ends.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(*columns, *[c.alias(f"order{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("tie"))
    by = [*[f"order{i}" for i in range(len(order))], "tie"]
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    few = partitions(spark)
    n = max(1, -(-size // unit_bytes), min(few, -(-size // LEAST_BYTES)))
    sorted_rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).drop(*by)
    placed = sorted_rows.select(F.spark_partition_id().alias("unit"), F.monotonically_increasing_id().alias("place"), *sorted_rows.columns)
    table, path = f"corvane_{name}_{uuid.uuid4().hex}", new_path(spark, name)
    placed.write.bucketBy(max(n, few), "unit").sortBy("unit", "place").option("path", path).saveAsTable(table)
    transient(spark, path)
    return spark.table(table), size


def sorted_by_place(table: pa.Table) -> pa.Table:
    """A unit's rows in order, in one chunk for each column."""
    return table.sort_by("place").combine_chunks()
