"""Document and chunk tables on Parquet: schemas, upsert, replace-on-reload, validation."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.sources.versions import Versions

_text, _int, _flag = T.StringType(), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DOCUMENTS = _struct(
    document_id=_text, filename=_text, filepath=_text, doc_type_category=_text, institution=_text, document_date=_text, document_year=_int,
    total_pages=_int, total_chunks=_int, char_count=T.LongType(), extraction_warnings=T.ArrayType(_text), created_at=T.TimestampType(),
)
CHUNKS = _struct(
    chunk_id=_text, document_id=_text, text=_text, char_count=_int, page_start=_int, page_end=_int, position_in_doc=_int, section_type=_text, section_confidence=T.DoubleType(),
    economic_variables=T.MapType(_text, _struct(importance=_text, mentions=_int, confidence=T.DoubleType())), numeric_values=T.ArrayType(_struct(value=_text, unit=_text, raw=_text)),
    entities=T.MapType(_text, _int), temporal_refs=_struct(years=T.ArrayType(_text), quarters=T.ArrayType(_text)), tags=T.ArrayType(_text), importance_score=T.DoubleType(),
    is_policy_decision=_flag, is_forward_looking=_flag, chunk_date=T.DateType(), embedding=T.ArrayType(T.FloatType()), embedding_model=_text,
)
SCHEMAS = {"documents": DOCUMENTS, "chunks": CHUNKS}
DEFAULTS = {"section_type": "CONTENIDO", "section_confidence": 0.0, "importance_score": 0.0, "is_policy_decision": False, "is_forward_looking": False}


def checked_name(name: str) -> str:
    """A table name, if it is one; anything else is refused before it gets into a statement."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"{name!r} is no table name")
    return name


def document_rows(documents: DataFrame) -> DataFrame:
    """documents with document_year from the date's first four characters, null where they are no number."""
    return documents.withColumn("document_year", F.substring("document_date", 1, 4).try_cast("int"))


def valid_chunks(chunks: DataFrame, dimension: int) -> DataFrame:
    """Chunks whose vector is there and has the dimension."""
    return chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") == dimension))


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, cast; missing ones are their default or null."""
    have = set(df.columns)
    return df.select(*[F.coalesce(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType), F.lit(DEFAULTS.get(f.name))).cast(f.dataType).alias(f.name) for f in schema])


def latest(rows: DataFrame, key: str = "document_id") -> DataFrame:
    """One row of each key, the same on every run: the greatest document_date where there is one, ties by all columns' hash."""
    order = [F.desc_nulls_last("document_date")] if "document_date" in rows.columns else []
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order, F.xxhash64(*[F.to_json(F.struct(*[F.col(c) for c in rows.columns]))])))
    return rows.withColumn("__row", number).where("__row = 1").drop("__row")


def upsert(old: DataFrame, new: DataFrame, key: str = "document_id", keep: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """new over old by key; columns in `keep` stay as they were where old has the key. Of rows that repeat a key in new, latest() keeps one."""
    new = latest(new, key)
    kept = [c for c in keep if c in old.columns and c in new.columns]
    before = old.select(key, *[F.col(c).alias(f"__{c}") for c in kept])
    merged = new.join(before, key, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in kept else F.col(c) for c in old.columns])
    return old.join(new.select(key), key, "left_anti").unionByName(merged)


def replace_chunks(old: DataFrame, new: DataFrame, key: str = "document_id") -> DataFrame:
    """old without the chunks of the documents that new brings, and new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


class Conflict(RuntimeError):
    """Other loads kept changing the same buckets."""


class Store:
    """Documents and chunks as Parquet under a folder, in buckets by document, behind numbered versions of both.

    A load writes new folders of the buckets it touches beside the old ones and then makes the next
    version, which names the folder of every bucket of both tables. Readers see all of a load or
    nothing, and a failed one changes nothing. Of loads that run at once, one makes the next version; the others add theirs to it, or
    run again on it if it touched one of their buckets, so that none is lost: a document that two bring is the later version's.
    What the current and the previous version name is kept, for readers that planned on it; older folders go.
    """

    #: How often a load runs again because others changed its buckets.
    TRIES = 10
    #: Identifiers of a load that are sent to all tasks, at most; of more, tables are shuffled to be joined. Stored MB a bucket from which rows that stay are copied where they lie.
    SENT, LARGE_MB = 1_000_000, 64

    def __init__(self, spark: SparkSession, folder: str, prefix: str = "", buckets: int = 64):
        self.spark, self.folder, self.prefix, self.buckets = spark, folder.rstrip("/"), prefix, buckets
        self.versions = Versions(spark, f"{self.folder}/{checked_name(prefix + 'tables')}.versions")

    def version(self) -> dict:
        """{"number", "tables": {table: {bucket: folder}}, "buckets": their number, "dimension": of the vectors, "before": folders of the version before}."""
        number, held = self.versions.current()
        return {"tables": {}, "buckets": self.buckets, "dimension": None, "before": []} | held | {"number": number}

    _version = version

    def _bucket(self, key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def frame(self, version: dict, table: str, some: list[int] | None = None) -> DataFrame:
        """A version's table, or some buckets of it; rows of an older schema get new columns as null."""
        paths = [f"{self.folder}/{name}" for b, name in version["tables"].get(table, {}).items() if some is None or int(b) in some]
        return as_schema(self.spark.read.parquet(*paths), SCHEMAS[table]) if paths else self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, table: str) -> DataFrame:
        """The table as it stands. None stored yet: no rows."""
        return self.frame(self.version(), table)

    def _large(self, version: dict, table: str, some: list[int]) -> bool:
        """Whether these buckets of a table have LARGE_MB each on average."""
        paths = [self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}") for b, n in version["tables"].get(table, {}).items() if int(b) in some]
        return bool(paths) and sum(p.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in paths) >= len(paths) * self.LARGE_MB * 1e6

    def _written(self, table: str, df: DataFrame, buckets: int, stay: DataFrame | None = None) -> dict[str, str]:
        """Writes rows in buckets, large ones in several tasks and files; gives the folder of each bucket that has rows. Those that stay aren't dealt out by bucket, as they come from buckets."""
        name = f"{checked_name(self.prefix + table)}-{uuid.uuid4().hex}"
        bucket = self._bucket("document_id", buckets)
        rows = as_schema(df, SCHEMAS[table]).withColumn("bucket", bucket).hint("rebalance", "bucket")
        if stay is not None:
            rows = as_schema(stay, SCHEMAS[table]).withColumn("bucket", bucket).unionByName(rows)
        rows.write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path) if s.isDirectory()]
        return {n.removeprefix("bucket="): f"{name}/{n}" for n in names if n.startswith("bucket=")}

    def _made(self, old: dict, new: dict[str, dict[str, str]], touched: list[int], dimension: int | None) -> bool:
        """Makes a version in which the touched buckets have these folders; False if another load changed one of them since `old`."""
        base = old
        while True:
            kept = {t: {b: n for b, n in base["tables"].get(t, {}).items() if int(b) not in touched} for t in SCHEMAS}
            tables = {t: kept[t] | new[t] for t in SCHEMAS}
            named = lambda x: {n.split("/")[0] for own in x.values() for n in own.values()}
            before = sorted(named(base["tables"]))
            if self.versions.made(base["number"] + 1, {"tables": tables, "buckets": base["buckets"], "dimension": dimension, "before": before}):
                break
            base = self.version()
            if base["dimension"] not in (None, dimension) or any(base["tables"].get(t, {}).get(str(b)) != old["tables"].get(t, {}).get(str(b)) for t in SCHEMAS for b in touched):
                return False
        for name in set(base["before"]) - named(tables) - set(before):
            self._delete(name)
        return True

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def setup(self, *, drop: bool = False) -> None:
        """Makes the tables, without rows, if they don't exist; drop: empties both."""
        for _ in range(self.TRIES):
            old = self.version()
            if not drop and old["number"]:
                return
            if self._made(old, {table: {} for table in SCHEMAS}, list(range(old["buckets"])), None):
                return
        raise Conflict("other loads kept changing the tables")

    def dimension(self) -> int | None:
        """The dimension of the stored vectors, as the version says; None if there are none."""
        return self.version()["dimension"]

    def load(self, documents: DataFrame, chunks: DataFrame, dimension: int) -> int:
        """Upserts documents and replaces their chunks; gives the number of chunks left out for their vector.

        Vectors of another dimension than the stored ones stop the load before anything is
        written. Chunks replace those of the documents that they name or that are loaded. Only the buckets of these documents are read and written.
        Where another load changes one of these buckets meanwhile, this one runs again on what that left, at most TRIES times.
        """
        new = as_schema(document_rows(documents), DOCUMENTS).withColumn("created_at", F.coalesce("created_at", F.current_timestamp()))
        fine = as_schema(valid_chunks(chunks, dimension), CHUNKS)
        ids = new.select("document_id").union(chunks.select("document_id")).distinct()
        skipped = chunks.where(F.col("embedding").isNull() | (F.size("embedding") != dimension)).count()
        for _ in range(self.TRIES):
            old = self.version()
            if old["dimension"] not in (None, dimension):
                raise ValueError(f"stored vectors have {old['dimension']} dimensions, new ones {dimension}")
            some = sorted(r["b"] for r in ids.select(self._bucket("document_id", old["buckets"]).alias("b")).distinct().collect())  # at most all buckets
            tables = self._merged(old, new, fine, ids, some)
            if tables is not None and self._made(old, tables, some, dimension):
                return skipped
            for name in {n.split("/")[0] for own in (tables or {}).values() for n in own.values()}:
                self._delete(name)
        raise Conflict(f"other loads changed the same buckets {self.TRIES} times")

    def _merged(self, old: dict, new: DataFrame, fine: DataFrame, ids: DataFrame, some: list[int]) -> dict | None:
        """The touched buckets with the new rows, written; None if later versions have taken away what this one reads."""
        try:
            gone = F.broadcast(ids) if ids.limit(self.SENT + 1).count() <= self.SENT else ids
            stay = self.frame(old, "chunks", some).join(gone, "document_id", "left_anti")
            apart = self._large(old, "chunks", some)
            return {
                "documents": self._written("documents", upsert(self.frame(old, "documents", some), new), old["buckets"]),
                "chunks": self._written("chunks", fine if apart else stay.unionByName(fine), old["buckets"], stay if apart else None),
            }
        except Exception:
            if self.version()["number"] <= old["number"] + 1:
                raise
            return None


def read_documents_json(spark: SparkSession, path: str, *, arrays: bool = False) -> DataFrame:
    """Documents of JSON lines, as write_json() makes them, or of files that hold one array each."""
    return spark.read.schema(DOCUMENTS).json(path, multiLine=arrays)


def read_chunks_json(spark: SparkSession, path: str, *, arrays: bool = False) -> DataFrame:
    """Chunks of JSON lines, or of files that hold one array each."""
    return spark.read.schema(CHUNKS).json(path, multiLine=arrays)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, characters as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
