"""Line dedup by distinct-site spread, with DataFrame functions only.

A HyperLogLog sketch of sites per line hash merges by aggregation. Lines whose
estimate is clearly over or under the limit are decided by it; those near it
get an exact distinct count. Cross-site boilerplate is then taken out of all
documents but the one where it first occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import let
from corvane.llm.common import dropped, written

#: Sites on which a line must occur to count as boilerplate.
MIN_SITES = 10
#: log2 of the sketch's registers, and the share by which an estimate may be off: six standard errors of 1.04 / sqrt(2**LOG_REGISTERS).
LOG_REGISTERS, MARGIN = 10, 0.2
#: Boilerplate lines up to which they are broadcast, about 40 bytes each, and tasks that share a line beyond that.
COMMON, SALTS = 200_000, 32
_BLANK = r"^[ \t\r\x0B\f]+|[ \t\r\x0B\f]+$"


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, _BLANK, "")


def _hashes(x: Column) -> list[Column]:
    """128 bits of hash in two columns."""
    return [F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("corvane"), x).alias("h2")]


def boilerplate(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """(h1, h2, first struct(id, pos)) as a written table: lines on min_sites or more sites, and where each occurs first."""
    lines = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    lines = lines.select("id", "site", "pos", _trimmed(F.col("line")).alias("line")).where("line <> ''").select("id", "site", "pos", *_hashes(F.col("line")))
    # A line is counted once a site and task before it is sent; texts are split once for sketches and exact counts.
    spread = written(lines.groupBy("h1", "h2", "site").agg(F.min(F.struct("id", "pos")).alias("first")), "spread")
    sketched = spread.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64("site"), F.lit(LOG_REGISTERS))).alias("estimate"), F.min("first").alias("first"))
    sure = sketched.where(F.col("estimate") > min_sites * (1 + MARGIN)).select("h1", "h2", "first")
    near = sketched.where(F.col("estimate").between(min_sites * (1 - MARGIN), min_sites * (1 + MARGIN))).select("h1", "h2", "first")
    exact = spread.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.countDistinct("site").alias("sites"), F.min("first").alias("first")).where(F.col("sites") >= min_sites)
    common = written(sure.unionByName(exact.select("h1", "h2", "first")), "boilerplate")
    dropped(spread)
    return common


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *, min_sites: int = MIN_SITES) -> DataFrame:
    """docs with boilerplate lines removed, and behind them the columns n_lines and n_removed (int).

    Lines end at \\n; they are compared without white space at their ends and
    case counts. A line on min_sites or more distinct sites stays only where it
    first occurs (smallest id, null before all, then position, in that text) and goes
    elsewhere, also where it repeats within a text. Blank lines stay. A
    null site is none; a null text stays null, with no lines; an empty one has one, blank line. Rows that repeat
    an id are treated alike: each keeps the first occurrence if it has it at that position. No row goes, even
    if none of its lines stays. Other columns are carried; where docs has a column n_lines or
    n_removed already, it stays and the new one has an underscore behind its name. An empty table gives no rows.
    """
    every = docs.columns
    taken = {c.lower() for c in every}
    n_lines, n_removed = (_free(name, taken) for name in ("n_lines", "n_removed"))
    common = boilerplate(docs, id_col, text_col, site_col, min_sites)
    few = common.count() <= COMMON

    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", _trimmed(F.col("line"))).where("line <> ''").select("id", "text_hash", "pos", *_hashes(F.col("line")))
    if few:  # the lines stay where they are
        found = lines.join(F.broadcast(common), ["h1", "h2"])
    else:  # a hot line's rows go to SALTS tasks
        lines = lines.withColumn("salt", F.pmod(F.xxhash64("id", "text_hash", "pos"), F.lit(SALTS)).cast("int"))
        found = lines.join(common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["h1", "h2", "salt"])
    gone = found.where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("pos") == F.col("first.pos"))))
    gone = gone.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone_at"))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in every]).alias("doc"), F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_hash"))
    d = d.join(gone, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    text = F.col("doc").getField(text_col)
    split = F.split(text, "\n")
    stays = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone_at"))
    kept = let(split, lambda lines: F.array_join(F.transform(stays(lines), lambda i: F.get(lines, i)), "\n"))  # in time that follows the number of lines
    cleaned = F.when(F.col("gone_at").isNull(), text).otherwise(kept)
    return d.select(
        *[(cleaned if c == text_col else F.col("doc").getField(c)).alias(c) for c in every],
        F.coalesce(F.size(split), F.lit(0)).alias(n_lines),
        F.coalesce(F.size("gone_at"), F.lit(0)).alias(n_removed),
    )


def _free(name: str, taken: set[str]) -> str:
    """A column name that isn't taken."""
    while name in taken:
        name += "_"
    return name
