"""Recall: exact vector top-n, lexical top-n by cover density, and the importance fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import vectors as V
from corvane.functions.text import let, lexemes


def vector_recall(chunks: DataFrame, query: Sequence[float], n: int = 50, *, id_col: str = "chunk_id", vector_col: str = "embedding") -> DataFrame:
    """The n chunks of the greatest cosine similarity as vector_score, ties by id. Each task keeps n rows; no full sort."""
    score = V.cosine(F.col(vector_col), V.literal(query))
    return chunks.where(F.size(vector_col) == len(query)).withColumn("vector_score", score).where("vector_score is not null").orderBy(F.desc("vector_score"), id_col).limit(n)


def query_lexemes(text: str) -> list[str]:
    """The distinct lexemes of a query, in order, as lexemes() makes them."""
    out, held = [], ""
    for c in text.lower() + " ":
        if c.isalpha() or c.isnumeric():
            held += c
        else:
            if held and held not in out:
                out.append(held)
            held = ""
    return out


def has_all(text: Column, terms: list[str]) -> Column:
    """Whether all lexemes occur; no lexemes match nothing."""
    return F.size(F.array_except(F.array(*map(F.lit, terms)), lexemes(text))) == 0 if terms else F.lit(False)


def cover_density(text: Column, terms: list[str]) -> Column:
    """The sum of 0.1 / (1 + noise) over minimal covers, noise being the words of a cover that are no query lexeme. See density()."""
    if not terms:
        return F.lit(0.0)
    where = F.array(*map(F.lit, terms))
    found = F.transform(lexemes(text), lambda w, i: F.struct(i.alias("at"), F.array_position(where, w).cast("int").alias("term")))
    return density(F.filter(found, lambda h: h["term"] > 0), len(terms))


def density(places: Column, terms: Column | int) -> Column:
    """Cover density of array<struct<at, term>>: where query lexemes, numbered from 1, occur, in order.

    A cover is a span with every lexeme that has no shorter one inside. One pass over the hits
    keeps each lexeme's last hit; a span ends at a hit when the smallest of these moves. Hits are
    numbered, so those inside a cover are a difference of numbers.
    """
    hits = F.transform(places, lambda h, i: F.struct(h["at"].alias("at"), h["term"].alias("term"), i.alias("n")))
    none = F.struct(F.lit(-1).alias("n"), F.lit(-1).alias("at"))
    start = F.struct(F.array_repeat(none, terms).alias("last"), F.lit(-1).alias("low"), F.lit(0.0).alias("sum"))

    def step(s: Column, h: Column) -> Column:
        own = F.struct(h["n"].alias("n"), h["at"].alias("at"))
        last = F.transform(s["last"], lambda x, i: F.when(i + 1 == h["term"], own).otherwise(x))

        def counted(both: Column) -> Column:
            low = F.array_min(both)
            noise = (h["at"] - low["at"]) - (h["n"] - low["n"])
            return F.when(low["n"] > s["low"], F.struct(both.alias("last"), low["n"].alias("low"), (s["sum"] + 0.1 / (1 + noise)).alias("sum"))).otherwise(F.struct(both.alias("last"), s["low"].alias("low"), s["sum"].alias("sum")))

        return let(last, counted)

    return F.aggregate(hits, start, step, lambda s: s["sum"])


def lexical_recall(chunks: DataFrame, query: str, n: int = 50, *, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """The n chunks with all query lexemes of the greatest cover density as lexical_score, ties by id.

    A cheap test for each lexeme runs before any text is split.
    """
    terms = query_lexemes(query)
    rows = chunks
    for t in terms:
        rows = rows.where(F.lower(text_col).contains(t))
    return rows.where(has_all(F.col(text_col), terms)).withColumn("lexical_score", cover_density(F.col(text_col), terms)).orderBy(F.desc("lexical_score"), id_col).limit(n)


def importance_recall(chunks: DataFrame, n: int, *, id_col: str = "chunk_id") -> DataFrame:
    """The fallback: the most important chunks, early pages first."""
    return chunks.orderBy(F.desc("importance_score"), F.asc("page_start"), id_col).limit(n)
