"""Embedding inference as an Arrow iterator, with any model."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType

from corvane.functions.text import normalized

#: A loader is sent to the executors and called once a worker; what it gives turns texts into (vectors, token counts).
Loader = Callable[[], Callable[[list[str]], tuple[np.ndarray, list[int]]]]


def hashed_words(dimension: int = 64) -> Loader:
    """A deterministic stand-in for a model: signed counts of hashed words."""

    def load() -> Callable[[list[str]], tuple[np.ndarray, list[int]]]:
        def encode(texts: list[str]) -> tuple[np.ndarray, list[int]]:
            out = np.zeros((len(texts), dimension), np.float32)
            counts = []
            for i, text in enumerate(texts):
                words = re.findall(r"\w+", normalized(text))
                counts.append(len(words))
                for w in words:
                    h = zlib.crc32(w.encode())
                    out[i, h % dimension] += 1 if h >> 31 else -1
            return out, counts

        return encode

    return load


def sentence_model(name: str, fallback: str | None = None) -> Loader:
    """A sentence-transformers model. Another model is only loaded in its place if a fallback is named."""

    def load() -> Callable[[list[str]], tuple[np.ndarray, list[int]]]:
        from sentence_transformers import SentenceTransformer

        try:
            model = SentenceTransformer(name)
        except Exception:
            if fallback is None:
                raise
            model = SentenceTransformer(fallback)

        def encode(texts: list[str]) -> tuple[np.ndarray, list[int]]:
            return model.encode(texts, normalize_embeddings=True, convert_to_numpy=True), [len(x) for x in model.tokenizer(texts)["input_ids"]]

        return encode

    return load


_models: dict[str, Callable] = {}


def _of_worker(key: str, load: Loader) -> Callable[[list[str]], tuple[np.ndarray, list[int]]]:
    """The model of this worker's process; another one takes its place."""
    if key not in _models:
        _models.clear()
        _models[key] = load()
    return _models[key]


def with_vectors(chunks: DataFrame, load: Loader, model: str, *, text_col: str = "embed_text", batch: int = 32) -> DataFrame:
    """chunks with embedding array<float>, n_tokens and embedding_model: unit vectors; a null text counts as empty.

    All columns go through one Arrow mapping, so nothing has to be joined back. A worker loads the model once, for all its tasks.
    """
    carried = [c for c in chunks.columns if c not in ("embedding", "n_tokens", "embedding_model")]
    at, key = carried.index(text_col), hashlib.sha256(cloudpickle.dumps(load)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _of_worker(key, load)
        for whole in batches:
            for s in range(0, whole.num_rows, batch):
                part = whole.slice(s, batch)
                vectors, counts = encode([t or "" for t in part.column(at).to_pylist()])
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)
                lists = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, vectors.shape[1], np.int32), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(counts, pa.int32()), pa.array([model] * part.num_rows, pa.string())], names=[*carried, "embedding", "n_tokens", "embedding_model"])

    rows = chunks.select(*carried)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("embedding", ArrayType(FloatType())), StructField("n_tokens", IntegerType()), StructField("embedding_model", StringType())]))


def vectorized(chunks: DataFrame, load: Loader, model: str, *, text_col: str = "embed_text", id_col: str = "chunk_id", batch: int = 32) -> DataFrame:
    """(id, embedding array<float>, n_tokens, embedding_model) of with_vectors()."""
    return with_vectors(chunks.select(id_col, text_col), load, model, text_col=text_col, batch=batch).drop(text_col)


@lru_cache(4)
def _loaded(load: Loader) -> Callable[[list[str]], tuple[np.ndarray, list[int]]]:
    """A loader's model, kept in this process for the queries to come."""
    return load()


def query_vector(text: str, load: Loader, model: str) -> list[float]:
    """One query's unit vector, with the query prefix that E5 models want."""
    vector = _loaded(load)(["query: " + text if "e5" in model.lower() else text])[0][0]
    norm = float(np.linalg.norm(vector))
    return [float(x) / norm if norm else 0.0 for x in vector]
