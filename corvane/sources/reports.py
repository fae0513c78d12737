"""Reports that are kept: partial counts of each bucket of a store, which loads change one bucket at a time.

A refresh counts the buckets whose folders have no counts yet; a report sums the counts of the version it is of and counts only
what has been loaded since. So it reads no chunk once a refresh has run, and replaces and deletes need no subtraction.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.sources.store import SCHEMAS, Store
from corvane.sources.versions import Versions

#: From this importance on a chunk counts as important.
HIGH = 0.6
COUNTS = "bucket int, kind string, name string, n long, total double"


class Reports:
    """Partial counts of a store's buckets, under a folder of their own."""

    def __init__(self, store: Store, folder: str):
        self.store, self.spark, self.folder = store, store.spark, folder.rstrip("/")
        self.versions = Versions(self.spark, f"{self.folder}/reports.versions")

    @staticmethod
    def _parts(version: dict) -> dict[str, str]:
        """The folders of both tables that each bucket consists of, as one name."""
        chunks, documents = (version["tables"].get(t, {}) for t in ("chunks", "documents"))
        return {b: f"{chunks.get(b, '')}|{documents.get(b, '')}" for b in {*chunks, *documents}}

    def _rows(self, version: dict, table: str, buckets: set[str]) -> DataFrame:
        """A table's rows in some buckets, with the bucket's number."""
        paths = [f"{self.store.folder}/{n}" for b, n in version["tables"].get(table, {}).items() if b in buckets]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[table]).withColumn("bucket", F.lit(None).cast("int"))
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths).select("*", F.regexp_extract("_metadata.file_path", r"/bucket=(\d+)/[^/]*$", 1).cast("int").alias("bucket"))

    def _counted(self, version: dict, buckets: set[str]) -> DataFrame:
        """COUNTS of some buckets. Both tables' rows of a document lie in the same bucket, so the join is one of counts within buckets."""
        chunks, documents = self._rows(version, "chunks", buckets), self._rows(version, "documents", buckets)
        row = lambda df, kind, name, n, total=F.lit(0.0): df.select("bucket", F.lit(kind).alias("kind"), name.alias("name"), n.cast("long").alias("n"), total.alias("total"))
        none = F.lit(None).cast("string")
        section = F.coalesce("section_type", F.lit("CONTENIDO"))
        score = F.coalesce("importance_score", F.lit(0.0))
        per_bucket = chunks.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(score).alias("total"), F.count_if(score >= HIGH).alias("high"), F.count_if("is_policy_decision").alias("policy"))
        per_document = chunks.groupBy("bucket", "document_id").agg(F.count("*").alias("n")).join(documents.select("bucket", "document_id", "doc_type_category"), ["bucket", "document_id"])
        of_documents = documents.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("total_chunks").alias("chunks"), F.count_if(F.col("total_chunks") == 0).alias("failed"), F.count_if(F.size("extraction_warnings") > 0).alias("warned"))
        count: Column = F.col("n")
        parts = [
            row(chunks.groupBy("bucket", section.alias("name")).agg(F.count("*").alias("n")), "section", F.col("name"), count),
            row(per_bucket, "chunks", none, count, F.col("total")),
            row(per_bucket, "high", none, F.col("high")),
            row(per_bucket, "policy", none, F.col("policy")),
            row(chunks.select("bucket", F.explode(F.map_keys("economic_variables")).alias("name")).groupBy("bucket", "name").agg(F.count("*").alias("n")), "variable", F.col("name"), count),
            row(per_document.groupBy("bucket", "doc_type_category").agg(F.sum("n").alias("n")), "type", F.col("doc_type_category"), count),
            row(of_documents, "documents", none, count),
            row(of_documents, "document_chunks", none, F.coalesce("chunks", F.lit(0))),
            row(of_documents, "failed", none, F.col("failed")),
            row(of_documents, "warned", none, F.col("warned")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def refresh(self) -> int:
        """Counts the buckets of the store's current version that have no counts; gives their number. Of two refreshes at once one is dropped."""
        version, (number, state) = self.store.version(), self.versions.current()
        parts, kept = self._parts(version), state.get("parts", {})
        missing = {b for b, p in parts.items() if p not in kept}
        live = {p: kept[p] for p in parts.values() if p in kept}
        if not missing and live == kept:
            return 0
        if missing:
            name = f"counts-{uuid.uuid4().hex}"
            self._counted(version, missing).coalesce(1).write.parquet(f"{self.folder}/{name}")  # some rows a bucket
            live |= {parts[b]: name for b in missing}
        if self.versions.made(number + 1, {"parts": live, "before": sorted(set(kept.values()))}):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for gone in set(state.get("before", [])) - set(live.values()) - set(kept.values()):
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{gone}"), True)
        return len(missing)

    def counts(self) -> DataFrame:
        """(kind, name, n, total) of the store's current version."""
        version = self.store.version()
        parts, kept = self._parts(version), self.versions.current()[1].get("parts", {})
        known: dict[str, list[int]] = {}
        for b, p in parts.items():
            if p in kept:
                known.setdefault(kept[p], []).append(int(b))
        out = [self.spark.read.schema(COUNTS).parquet(f"{self.folder}/{name}").where(F.col("bucket").isin(own)) for name, own in sorted(known.items())]
        missing = {b for b, p in parts.items() if p not in kept}
        if missing:
            out.append(self._counted(version, missing))
        rows = self.spark.createDataFrame([], COUNTS)
        for x in out:
            rows = rows.unionByName(x)
        return rows.groupBy("kind", "name").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def _of(self, kind: str, name: str, n: str) -> DataFrame:
        return self.counts().where(F.col("kind") == kind).select(F.col("name").alias(name), F.col("n").alias(n))

    def by_type(self) -> DataFrame:
        """As stats.by_type()."""
        return self._of("type", "doc_type_category", "chunks").orderBy(F.desc("chunks"), "doc_type_category")

    def by_section(self) -> DataFrame:
        """As stats.by_section()."""
        return self._of("section", "section_type", "chunks").orderBy(F.desc("chunks"), "section_type")

    def key_histogram(self, most: int = 10) -> DataFrame:
        """As stats.key_histogram() of the variables."""
        return self._of("variable", "name", "chunks").orderBy(F.desc("chunks"), "name").limit(most)

    def importance_summary(self) -> DataFrame:
        """As stats.importance_summary()."""
        n = lambda kind, c="n": F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(c))), F.lit(0))
        rows = self.counts().agg(n("chunks").alias("chunks"), n("chunks", "total").alias("total"), n("high").alias("high"), n("policy").alias("policy_decisions"))
        return rows.select("chunks", F.when(F.col("chunks") > 0, F.round(F.col("total") / F.col("chunks"), 3)).alias("mean_importance"), "high", F.floor(100 * F.col("high") / F.greatest(F.lit(1), "chunks")).alias("high_percent"), "policy_decisions")

    def extraction_report(self) -> DataFrame:
        """As stats.extraction_report() of the stored documents."""
        n = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
        return self.counts().agg(n("documents").alias("documents"), n("document_chunks").alias("chunks"), n("failed").alias("failed"), n("warned").alias("with_warnings"))
