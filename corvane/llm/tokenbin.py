"""Token ids as binary shards with Elias-Fano document boundaries.

A shard file holds consecutive documents:

    8 bytes  magic "CVTOKENS"
    8 bytes  each: number of documents, number of ids, bytes of an id (2 or 4),
             position of the boundaries, position of the document ids
    ids      concatenated, unsigned, little endian
    boundaries  Elias-Fano code of each document's end within the shard
    document ids  signed 64-bit, little endian; a null is the smallest number

A document's ids lie between two selects; no table of 64-bit offsets is kept.
Shards are written under another name and renamed, so a task that is repeated
leaves one whole file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corvane.llm.bpememo import ENCODED_BYTES, encoder
from corvane.llm.common import as_batch, by_arrow, new_path, partitions, text_slices, transient, written
from corvane.llm.eliasfano import EliasFano, encoded

MAGIC = b"CVTOKENS"
NULL_ID = -(1 << 63)
_HEAD = 48


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path, local or not, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


class Shard:
    """Reads one shard file; a local one is mapped, not loaded."""

    def __init__(self, uri: str):
        store, path = _store(uri)
        if isinstance(store, pyarrow.fs.LocalFileSystem):
            self.buffer = pa.memory_map(path).read_buffer()
        else:
            self.buffer = store.open_input_file(path).read_buffer()
        if self.buffer[:8].to_pybytes() != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        self.documents, self.tokens, self.id_bytes, self.at_bounds, self.at_ids = map(int, np.frombuffer(self.buffer, "<u8", 5, 8))
        self.bounds = EliasFano(self.buffer, self.at_bounds)
        self.doc_ids = np.frombuffer(self.buffer, "<i8", self.documents, self.at_ids)
        self.ids = np.frombuffer(self.buffer, f"<u{self.id_bytes}", self.tokens, _HEAD)

    def bound(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of these documents within the shard."""
        index = np.asarray(index, np.int64)
        ends = self.bounds.select(np.concatenate([index, np.maximum(index - 1, 0)])).astype(np.int64)
        return np.where(index > 0, ends[len(index) :], 0), ends[: len(index)]

    def document(self, i: int) -> np.ndarray:
        start, end = self.bound(np.array([i]))
        return self.ids[int(start[0]) : int(end[0])]


def write_shards(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 2, vocabulary: int | None = None, shards: int | None = None) -> DataFrame:
    """Writes docs' ids in ascending id order and gives (shard, path, documents, tokens), a row for each file.

    A null id comes first, a null text is an empty one, rows that repeat an id
    follow the order of their texts' hashes. Each document ends with end_id. Ids take two bytes if all of the vocabulary do, of which the tokenizer
    tells the size if none is given, else four; an id that doesn't fit stops the job. An empty table gives no files.
    """
    vocabulary = vocabulary or Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encode = encoder(tokenizer).encode_column
        store, root = _store(folder)
        own, final = f"{root}/.{shard}-{uuid.uuid4().hex}", f"{root}/{shard:06d}.tok"
        doc_ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        out = None
        for part in text_slices(batches, "text", ENCODED_BYTES):
            if out is None:
                store.create_dir(root)
                out = store.open_output_stream(own + ".ids")
            ids, bounds = encode(part.column(1))
            if width == 2 and len(ids) and ids.max() >= 1 << 16:
                raise ValueError(f"the id {ids.max()} is beyond a vocabulary of {vocabulary}")
            out.write(np.insert(ids, bounds[1:], end_id).astype(kind).tobytes())
            lengths.append(np.diff(bounds) + 1)
            doc_ids.append(part.column(0).fill_null(NULL_ID).to_numpy())
        if out is None:
            return
        out.close()
        ends = np.cumsum(np.concatenate(lengths))
        n, total = len(ends), int(ends[-1])
        pad = -(total * width) % 8
        bounds = encoded(ends, total)
        at_bounds = _HEAD + total * width + pad
        with store.open_output_stream(own) as whole, store.open_input_stream(own + ".ids") as held:
            whole.write(MAGIC + np.array([n, total, width, at_bounds, at_bounds + len(bounds)], "<u8").tobytes())
            while block := held.read(1 << 22):
                whole.write(block)
            whole.write(bytes(pad) + bounds + np.concatenate(doc_ids).astype("<i8").tobytes())
        store.delete_file(own + ".ids")
        store.move(own, final)
        yield as_batch({"shard": pa.array([shard], pa.int32()), "path": pa.array([f"{folder}/{shard:06d}.tok"]), "documents": pa.array([n], pa.int64()), "tokens": pa.array([total], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards or partitions(docs.sparkSession), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return by_arrow(order, write, "shard int, path string, documents long, tokens long")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) of every document in the files of a manifest, from the files."""
    # A row for each file: their running total fits one task.
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    dealt = based.repartition(partitions(manifest.sparkSession), "shard").select("shard", "path", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, base in zip(*(c.to_pylist() for c in batch.columns)):
                held = Shard(path)
                for a in range(0, held.documents, 4096):
                    index = np.arange(a, min(a + 4096, held.documents))
                    start, end = held.bound(index)
                    crc = [crc32(held.ids[s:e].astype("<u4").tobytes()) for s, e in zip(start.tolist(), end.tolist())]
                    ids = held.doc_ids[index]
                    yield as_batch({
                        "doc_id": pa.array(ids, pa.int64(), mask=ids == NULL_ID),
                        "start": pa.array(start + base),
                        "n_tokens": pa.array(end - start),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "shard": pa.array([shard] * len(index), pa.int32()),
                    })

    return by_arrow(dealt, read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, *, end_id: int = 2, vocabulary: int | None = None) -> DataFrame:
    """Writes the shards of docs and reads them back: (doc_id, start, n_tokens, ids_crc32, shard), a row for each row of docs.

    Nulls, ties, repeated rows and empty tables as write_shards() has them; very long texts are one document each; other columns
    are not read. Without a folder the files lie in the shared one until the driver ends.
    """
    spark = docs.sparkSession
    path = folder or new_path(spark, "tokens")
    manifest = written(write_shards(docs, tokenizer, path, end_id=end_id, vocabulary=vocabulary), "manifest")
    if folder is None:
        transient(spark, path)
    return read_shards(manifest)
