"""Helpers that the operators share: written intermediate tables and Arrow mapping."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of an Arrow batch sent to Python. Documents may be long, so batches are short.
BATCH_ROWS = 1000
#: Rows from which a join key counts as hot, how many keys may, and tasks that share the rows of one.
HOT_ROWS, HOT_KEYS, HOT_SALTS = 1024, 1000, 64
#: Text bytes handled at once by the vectorised text code.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset and the master is local (tests on one machine) a temporary folder is made and set; on a cluster it must be set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="corvane-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/corvane-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder. It cuts the lineage and outlives executors, until the driver's JVM ends."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    transient(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.corvane_path = path
    return out


def _on_store(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path for it."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()), held


def transient(spark: SparkSession, path: str) -> None:
    """Has the driver's JVM delete a path of the shared folder when it ends: lazy results may read it until then."""
    store, held = _on_store(spark, path)
    store.deleteOnExit(held)


def dropped(df: DataFrame) -> None:
    """Deletes what written() wrote, once nothing reads it any more."""
    store, held = _on_store(df.sparkSession, df.corvane_path)
    store.delete(held, True)
    store.cancelDeleteOnExit(held)


def spread_join(rows: DataFrame, other: DataFrame, keys: list[str], weights: DataFrame, how: str = "left") -> DataFrame:
    """rows joined with other, whose keys don't repeat, without hot tasks: weights(keys, n) tells how many rows a key has.

    The rows of keys with many, at most HOT_KEYS of them by number, are spread over HOT_SALTS tasks, and
    other's row is repeated for each. Which keys are hot changes where rows go, never the result.
    """
    hot = weights.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n"), *keys).limit(HOT_KEYS).select(*keys, F.lit(True).alias("_hot"))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_SALTS))).otherwise(0).cast("int")).drop("_hot")
    each = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = other.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(each)).drop("_hot")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to; it looks for them when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def tuned(spark: SparkSession) -> None:
    """Short Arrow batches, so that long documents don't fill a worker's memory."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def returned() -> None:
    """Gives freed memory of this worker back to the machine: workers live on between tasks, beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def by_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """mapInArrow with short batches; a task gives back what its worker doesn't need any more."""
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        returned()

    return df.mapInArrow(run, schema)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text; a longer text has a slice of its own."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def as_batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sets for its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
