"""Phrase collocations: n-gram counts from suffix arrays of word ids, and the cut of each phrase that binds least.

Units of texts of one language or a few are the shards. The first pass orders each one's words by prefix doubling
and counts words and pairs from the intervals of common prefixes; count-min sketches, merged by range of cells, tell
each unit which of them may be frequent. The second pass builds the suffix array of the stretches of frequent pairs, as a phrase
is frequent only if all its pairs are, and sends each shard's counts of phrases, which are merged by key. What follows,
cuts, scores, longer phrases and ranks, are joins and aggregates on the frequent phrases.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import dropped, freed, partitions, returned, spread_join, tuned, written
from corvane.llm.countmin import REQUEST, Sketch
from corvane.llm.suffixes import common_prefixes, ngrams, suffix_order
from corvane.llm.textnum import LOWER, U, column_bytes, joined_words, mix, word_hashes, word_spans
from corvane.llm.units import in_units, sorted_by_place

#: Words of the longest phrase, occurrences of a candidate, and phrases of a language that are returned.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Text bytes of a unit, and for each cell of a row of the sketch.
UNIT, CELL_BYTES = 8 << 20, 24
#: Languages up to which their totals are broadcast, some 30 bytes each.
LANGS = 10_000
_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[*b" \t"]] = True
#: Text bytes for each shard of the counts, which are merged by a hash of their phrase.
SHARD_BYTES = 6 << 20
SHEETS, COUNTS = "shard int, sheet binary", "lang string, words int, phrase string, f long"


class Shard:
    """The words of a unit's texts: hashes by language, ids, and how many words follow each in its piece, itself included."""

    def __init__(self, table: pa.Table):
        data, offsets = column_bytes(table.column("text").combine_chunks())
        self.data = LOWER[data]
        self.starts, self.ends, self.rows = word_spans(self.data, offsets, _BREAK | _GAP)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        self.langs, own = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        salt = np.array([hash_of(name) for name in self.langs], np.uint64)
        self.lang = own[self.rows]
        self.hashes = mix(word_hashes(self.data, self.starts, self.ends) ^ salt[self.lang]) if len(self.rows) else np.zeros(0, np.uint64)
        piece = np.cumsum(_BREAK[self.data])[self.starts] if len(self.rows) else np.zeros(0, np.int64)
        on = np.zeros(len(self.rows), bool)  # whether the next word is in the same piece
        on[:-1] = (self.rows[1:] == self.rows[:-1]) & (piece[1:] == piece[:-1])
        self.next = on
        self.known, ids = np.unique(self.hashes, return_inverse=True)
        self.ids = ids.astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order by two words, the first place and size of each pair's interval, and the keys and counts of all words and pairs."""
        left = 1 + self.next.astype(np.int8)
        order = suffix_order(self.ids, left, 2)
        begins, first, sizes = ngrams(left, order, common_prefixes(self.ids, left, order, 2), 2)
        keys = np.concatenate([self.known, mix(self.hashes[first] * U(0x9E3779B97F4A7C15) + (self.hashes[first + 1] if len(first) else first.astype(np.uint64)))])
        return order, begins, sizes, keys, np.concatenate([np.bincount(self.ids, minlength=len(self.known)), sizes])


def hash_of(name: str) -> int:
    """64 bits of hash of a language's name, as every task makes them."""
    data = np.frombuffer(b" " + name.encode(), np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def stretches(shard: Shard, over: np.ndarray, order: np.ndarray, begins: np.ndarray, sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be frequent, and how many words each has before a pair that isn't; over: whether words and pairs may be."""
    word, pair = over[: len(shard.known)], np.zeros(len(shard.ids), bool)
    frequent = over[len(shard.known) :]
    at = np.repeat(begins[frequent], sizes[frequent])
    within = np.arange(len(at)) - np.repeat(np.cumsum(sizes[frequent]) - sizes[frequent], sizes[frequent])
    pair[order[at + within]] = True
    own = word[shard.ids]
    pair[:-1] &= own[:-1] & own[1:]
    held = np.flatnonzero(own)
    left = np.ones(len(shard.ids), np.int8)
    run = pair.copy()
    for k in range(1, longest):
        left += run
        run[:-k] &= pair[k:]
        run[-k:] = False
    return held, left[held]


def packed(table: pa.Table) -> bytes:
    """A table's columns in compressed form: counts travel as one sheet of each unit and shard."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def merged(sheets: DataFrame, least: int) -> DataFrame:
    """Sheets of all units, by shard, to COUNTS: the sums of each phrase that reach `least`, and all totals."""

    def added(table: pa.Table) -> pa.Table:
        counts = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in table.column("sheet").to_pylist()])
        sums = counts.group_by(["lang", "words", "phrase"], use_threads=False).aggregate([("n", "sum")])
        out = sums.filter((pa.compute.field("words") == 0) | (pa.compute.field("n_sum") >= least)).rename_columns({"n_sum": "f"}).select(["lang", "words", "phrase", "f"])
        del counts, sums
        returned()
        return out

    return sheets.groupBy("shard").applyInArrow(added, COUNTS)


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int) -> DataFrame:
    """(lang, words, phrase, f long): all words and phrases that occur `least` times or more, and a language's words as words = 0; a written table."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    units, size = in_units(docs, [lang.alias("lang"), text.alias("text")], [lang, F.xxhash64(text)], "phrases", UNIT)
    freed(spark)
    sketch = Sketch.of(size // CELL_BYTES, min(least, 255), partitions(spark))
    shards = max(partitions(spark), size // SHARD_BYTES)

    def counted(key: tuple, table: pa.Table) -> pa.Table:
        *_, keys, counts = Shard(sorted_by_place(table)).pairs()
        out = sketch.requests(key[0].as_py(), keys, counts)
        returned()
        return out

    def sent(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(sorted_by_place(table))
        order, begins, sizes, asked, _ = shard.pairs()
        held, left = stretches(shard, sketch.reached(asked, answers), order, begins, sizes, longest)
        ids = shard.ids[held]
        order = suffix_order(ids, left, longest)
        prefixes = common_prefixes(ids, left, order, longest)
        keys = [np.zeros(len(shard.langs), np.uint64)]
        out = [pa.table({"lang": pa.array(shard.langs, pa.string()), "words": pa.array([0] * len(shard.langs), pa.int32()), "phrase": pa.array([""] * len(shard.langs), pa.string()), "n": pa.array(np.bincount(shard.lang, minlength=len(shard.langs)).astype(np.int64))})]
        names = pa.array(shard.langs, pa.string())
        for n in range(1, longest + 1):
            _, first, many = ngrams(left, order, prefixes, n)
            at = held[first]
            text = joined_words(shard.data, shard.starts, shard.ends, (at[:, None] + np.arange(n)).ravel(), np.arange(len(at) + 1) * n)
            key = shard.hashes[at]
            for k in range(1, n):
                key = key * U(0x9E3779B97F4A7C15) + shard.hashes[at + k]
            keys.append(mix(key))
            out.append(pa.table({"lang": names.take(pa.array(shard.lang[at])), "words": pa.array(np.full(len(at), n, np.int32)), "phrase": text.cast(pa.string()), "n": pa.array(many.astype(np.int64))}))
        counts, to = pa.concat_tables(out).combine_chunks(), np.concatenate(keys) % U(shards)
        by = np.argsort(to, kind="stable")
        counts, at = counts.take(pa.array(by)), np.searchsorted(to[by], np.arange(shards + 1, dtype=np.uint64))
        full = np.flatnonzero(at[1:] > at[:-1]).tolist()
        sheets = pa.table({"shard": pa.array(full, pa.int32()), "sheet": pa.array([packed(counts.slice(at[i], at[i + 1] - at[i])) for i in full], pa.binary())})
        del shard, order, keys, held, left, ids, prefixes, out, counts
        returned()
        return sheets

    grouped = units.groupBy("unit")
    estimates = written(sketch.answers(grouped.applyInArrow(counted, REQUEST)), "estimates")
    freed(spark)
    frequent = written(merged(grouped.cogroup(estimates.groupBy("unit")).applyInArrow(sent, SHEETS), least), "frequent")
    dropped(estimates)
    freed(spark)
    return frequent


def _inner(words: Column, of: Column) -> Column:
    """All contiguous parts of a phrase that have two words or more and fewer than it."""
    return F.flatten(F.transform(F.sequence(F.lit(2), of - 1), lambda m: F.transform(F.sequence(F.lit(1), of - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases by score, then a, both descending, then phrase.

    Texts are cut at .,;:!? and \\x0A-\\x0D into pieces and these into words, runs of other characters than \\x20 and \\x09, with A-Z
    lower-cased. Candidates are the phrases of 2 to `longest` words that occur a >= `least` times within pieces, overlaps
    included. Of the cuts of a candidate in two, with l and r occurrences of the parts and n words of the language, the one of the
    least floor(1000 a n / (l r)) counts, of ties the earliest. A candidate goes if all its occurrences lie in one longer candidate's: 100 f(longer) >= 100 a.
    A null language is `und`; a null or empty text has no words; copies count each time; ids aren't read, so rows may repeat. Long texts
    are read whole. Other columns are not read. An empty table gives no rows. Scores are exact up to 38 digits.
    """
    tuned(docs.sparkSession)
    frequent = phrase_counts(docs, text_col, lang_col, least, longest)
    totals = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    known = frequent.where("words > 0").select("lang", "phrase", "f")
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring(phrase, char_length(head) + 2)"))
    for part, count in (("head", "l"), ("tail", "r")):
        other = known.select(F.col("lang"), F.col("phrase").alias(part), F.col("f").alias(count))
        cut = spread_join(cut, other, ["lang", part], cut.groupBy("lang", part).agg(F.count("*").alias("n")), "inner")
    few = totals.limit(LANGS + 1).count() <= LANGS
    cut = cut.join(F.broadcast(totals) if few else totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("above", (F.lit(1000).cast("decimal(4,0)") * whole("a")).cast("decimal(23,0)") * whole("n")).withColumn("below", whole("l") * whole("r"))
    cut = cut.withColumn("score", F.expr("above div below"))
    scored = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.max("a").alias("a"), F.max("n").alias("n"))

    inside = candidates.where("words > 2").select("lang", "a", F.explode(_inner(F.split("phrase", " "), F.col("words"))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = scored.join(inside, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = alone.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession))).alias("part"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)  # so that at most top rows of each part meet
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
