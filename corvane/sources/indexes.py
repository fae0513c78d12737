"""Indexes over a store's chunks that follow its loads: postings for lexical recall, cells for vector recall.

A store writes a new folder for each bucket that a load touches, and a folder never changes. The indexes are kept by folder: a
refresh indexes the folders of the current version that have none, and a search uses those of the version that it reads and
scans the chunks of folders that aren't indexed yet. So hits are always those of the tables as they stand, whether or not a
refresh has run since the last load.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import index as cells
from corvane.operators import lexical, recall
from corvane.sources.store import Store
from corvane.sources.versions import Versions

#: The number of vectors by which cells may have grown before their centroids are fitted again, as a factor.
GROWTH = 4


def _name(folder: str) -> str:
    """A bucket's folder as the value of a partition column."""
    return folder.replace("/bucket=", "-")


def _named(state: dict) -> set[str]:
    return {*state["lexical"].values(), *state["vectors"].values(), *([state["centroids"]] if state["centroids"] else [])}


class Indexes:
    """Postings and cells of a store's chunks, under a folder of their own."""

    def __init__(self, store: Store, folder: str):
        self.store, self.spark, self.folder = store, store.spark, folder.rstrip("/")
        self.versions = Versions(self.spark, f"{self.folder}/index.versions")

    def _state(self) -> dict:
        """{"number", "lexical": {part: folder}, "vectors": {part: folder}, "centroids": folder or None, "probes", "fitted": vectors at the last fit, "before": folders of the state before}."""
        number, held = self.versions.current()
        return {"lexical": {}, "vectors": {}, "centroids": None, "probes": 0, "fitted": 0, "before": []} | held | {"number": number}

    def _chunks(self, version: dict, parts: set[str], columns: list[str]) -> DataFrame:
        """Chunks of some buckets, with the bucket's folder as `part`."""
        paths = [f"{self.store.folder}/{n}" for n in version["tables"].get("chunks", {}).values() if _name(n) in parts]
        rows = self.spark.read.schema("chunk_id string, text string, embedding array<float>").parquet(*paths)
        part = F.regexp_replace(F.regexp_extract("_metadata.file_path", r"([^/]+/bucket=\d+)/[^/]*$", 1), "/bucket=", "-")
        return rows.select(*columns, part.alias("part"))

    def refresh(self, *, wanted: float = 0.95, n: int = 20) -> dict[str, int]:
        """Indexes what isn't indexed of the store's current version and forgets what no version names; gives the number of buckets indexed.

        Of two refreshes at once the one that ends later is dropped: its work is done again by the next. The number of cells a query looks at is
        measured again each time; centroids are fitted again when the vectors have become GROWTH times as many.
        """
        version, state = self.store.version(), self._state()
        live = {_name(x) for x in version["tables"].get("chunks", {}).values()}
        words, vectors = live - set(state["lexical"]), live - set(state["vectors"])
        new = {k: {p: f for p, f in state[k].items() if p in live} for k in ("lexical", "vectors")}
        if words:
            name = f"lexical-{uuid.uuid4().hex}"
            lexical.postings(self._chunks(version, words, ["chunk_id", "text"]), part_cols=("part",)).write.partitionBy("part").parquet(f"{self.folder}/{name}")
            new["lexical"] |= dict.fromkeys(words, name)
        made = state | new
        if vectors and version["dimension"]:
            made |= self._vectors(version, new["vectors"], live, vectors, state, wanted, n)
        if made == state:
            return {"lexical": 0, "vectors": 0}
        number = made.pop("number")
        made["before"] = sorted(_named(state))
        if self.versions.made(number + 1, made):
            self._forget(set(state["before"]) - _named(state) - _named(made))
        return {"lexical": len(words), "vectors": len(vectors) if made["centroids"] else 0}

    def _vectors(self, version: dict, kept: dict[str, str], live: set[str], missing: set[str], state: dict, wanted: float, n: int) -> dict:
        dimension = version["dimension"]
        total = self._chunks(version, live, ["embedding"]).where(F.size("embedding") == dimension).count()
        if not total:
            return {}
        if state["centroids"] and total <= GROWTH * state["fitted"]:
            middles, fitted, folder = self._centroids(state["centroids"]), state["fitted"], state["centroids"]
        else:  # all buckets anew
            middles = cells.fitted(self._chunks(version, live, ["chunk_id", "embedding"]).where(F.size("embedding") == dimension), dimension, total)
            fitted, kept, missing, folder = total, {}, live, f"centroids-{uuid.uuid4().hex}"
            self.spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(middles)], "cell int, centroid array<double>").coalesce(1).write.parquet(f"{self.folder}/{folder}")
        name = f"vectors-{uuid.uuid4().hex}"
        rows = self._chunks(version, missing, ["chunk_id", "embedding"]).where(F.size("embedding") == dimension)
        cells.assigned(rows, middles, dimension).repartitionByRange("part", "cell", "chunk_id").sortWithinPartitions("part", "cell").write.partitionBy("part").parquet(f"{self.folder}/{name}")
        parts = kept | dict.fromkeys(missing, name)
        index = cells.CellIndex(self._indexed(parts, _VECTORS), middles, len(middles), "embedding")
        sample = cells.sampled(index.rows, dimension, cells.QUERIES)
        return {"vectors": parts, "centroids": folder, "fitted": fitted, "probes": cells.measured(index, sample, n, wanted)}

    def _centroids(self, folder: str) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.folder}/{folder}").orderBy("cell").collect()  # at most cells.CELLS rows
        return np.array([r["centroid"] for r in rows])

    def _indexed(self, parts: dict[str, str], schema: str) -> DataFrame:
        """The index rows of these parts."""
        if not parts:
            return self.spark.createDataFrame([], schema + ", part string")
        out = None
        for folder in sorted(set(parts.values())):
            own = [p for p, f in parts.items() if f == folder]
            rows = self.spark.read.schema(schema + ", part string").parquet(f"{self.folder}/{folder}").where(F.col("part").isin(own))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _forget(self, gone: set[str]) -> None:
        """Deletes folders that neither this description nor the one before names."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in gone:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}"), True)

    def at(self, version: dict) -> Snapshot:
        """What is indexed of a version of the store."""
        return Snapshot(self, version, self._state())


_POSTINGS = "term string, id string, n int, at array<int>"
_VECTORS = "chunk_id string, embedding array<float>, cell int"


class Snapshot:
    """One version of a store with its indexes: two recalls over (chunk_id)s, exact for buckets that aren't indexed."""

    def __init__(self, indexes: Indexes, version: dict, state: dict):
        self.indexes, self.version = indexes, version
        self.live = {_name(x) for x in version["tables"].get("chunks", {}).values()}
        self.words = {p: f for p, f in state["lexical"].items() if p in self.live}
        self.vectors = {p: f for p, f in state["vectors"].items() if p in self.live}
        self.centroids, self.probes = state["centroids"], state["probes"]

    def lexical(self, allowed: DataFrame, query: str, n: int) -> DataFrame:
        """(chunk_id, lexical_score) of the n best of the allowed (chunk_id)s, as lexical_recall() finds them."""
        terms, rest = recall.query_lexemes(query), self.live - set(self.words)
        found = lexical.top(self.indexes._indexed(self.words, _POSTINGS), terms, n, allowed.select(F.col("chunk_id").alias("id"))).select(F.col("id").alias("chunk_id"), "lexical_score")
        if rest:
            rows = self.indexes._chunks(self.version, rest, ["chunk_id", "text"]).join(allowed.select("chunk_id"), "chunk_id", "left_semi")
            found = found.unionByName(recall.lexical_recall(rows, query, n).select("chunk_id", "lexical_score"))
        return found.orderBy(F.desc("lexical_score"), "chunk_id").limit(n)

    def near(self, allowed: DataFrame, vector: Sequence[float], n: int) -> DataFrame:
        """(chunk_id, vector_score) of the n nearest of the allowed (chunk_id)s in the cells near the query; buckets without cells are read whole."""
        rest, rows = self.live - set(self.vectors), None
        if self.vectors and self.centroids:
            index = cells.CellIndex(self.indexes._indexed(self.vectors, _VECTORS), self.indexes._centroids(self.centroids), self.probes, "embedding")
            rows = index.cells(vector).select("chunk_id", "embedding")
        if rest:
            scanned = self.indexes._chunks(self.version, rest, ["chunk_id", "embedding"]).drop("part")
            rows = scanned if rows is None else rows.unionByName(scanned)
        if rows is None:
            rows = self.indexes.spark.createDataFrame([], "chunk_id string, embedding array<float>")
        return recall.vector_recall(rows.join(allowed.select("chunk_id"), "chunk_id", "left_semi"), vector, n).select("chunk_id", "vector_score")
