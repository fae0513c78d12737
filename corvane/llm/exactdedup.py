"""Exact dedup with a heavy-hitter split, with DataFrame functions only.

Spark's approx_top_k is the frequent-items sketch, a Misra-Gries summary that
merges; it proposes frequent digests. Exact counts confirm them, and the few
winners, at most HEAVY rows, are broadcast: their copies are told apart where
they are read. Only the other digests are shuffled, so that no shuffle key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import written

#: Frequent digests that the sketch proposes, and counters it keeps. HEAVY bounds what is broadcast.
HEAVY, COUNTERS = 1000, 32_768
#: Copies from which a proposed digest counts as heavy.
HEAVY_COPIES = 64
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size long, kept boolean, text_sha256 string), a row for each row of docs.

    Texts are equal when identical after lower-casing A-Z; a null text is an
    empty one. The row with the largest id of a group stays; a null id is
    smaller than any other. Rows that repeat id and text are all marked as
    kept if theirs is the largest id. Very long texts are hashed whole, in the JVM, and only their digests travel.
    An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _SMALL)
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest")), "digests")

    # approx_top_k takes numbers and strings; 63 bits of the digest are enough to propose candidates.
    short = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    top = rows.select(short.alias("short")).agg(F.expr(f"approx_top_k(short, {HEAVY}, {COUNTERS})").alias("top"))
    proposed = top.select(F.explode("top").alias("t")).where(F.col("t.count") >= HEAVY_COPIES).select(F.col("t.item").alias("short"))
    counted = rows.withColumn("short", short).join(F.broadcast(proposed), "short", "left_semi").groupBy("digest").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    winners = written(counted.where(F.col("group_size") >= HEAVY_COPIES).orderBy(F.desc("group_size"), "digest").limit(HEAVY), "winners")

    marked = rows.join(F.broadcast(winners), "digest", "left")
    heavy = marked.where("group_size is not null").select("doc_id", "digest", "group_size", "keep_id")
    rest = marked.where("group_size is null").select("doc_id", "digest")
    groups = rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    rest = rest.join(groups, "digest").select("doc_id", "digest", "group_size", "keep_id")
    return heavy.union(rest).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
