"""Pages to overlapping chunks, as folds over arrays inside the JVM.

Each document is one row and folds on its own, so chunking needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as T

TARGET, LEAST, LONGEST, OVERLAP = 600, 200, 1200, 100
#: Values that a fold takes at once, at least.
BLOCK = 16
_UNIT = "struct<text:string,page:int,section:string>"
_CHUNK = "struct<text:string,page_start:int,page_end:int,section:string>"


def _folded(values: Column, start: dict[str, Column], step: Callable[[Column, Column, Callable], Column], kind: str, finish: Callable[[Column, Column], Column]) -> Column:
    """A fold whose state is `start` and a growing array of `kind`; finish gets the last state and the whole array.

    Step gets the state, a value, and a function that makes the next state of new fields and, if any, an array to append.
    An aggregate copies its state, strings and all, at every value. So the fold runs over blocks, whose size follows the
    root of the number of values: neither a block's state nor the list of blocks is copied often while it is large.
    """
    empty = F.array().cast(f"array<{kind}>")
    state = lambda own, out: F.struct(*[own[f].alias(f) for f in start], out.alias("out"))
    one = lambda s, v: step(s, v, lambda own, new=None: state(own, s["out"] if new is None else F.concat(s["out"], new)))

    def of(v: Column) -> Column:
        size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(v)))).cast("int")
        blocks = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))
        first = F.struct(*[c.alias(f) for f, c in start.items()], F.array().cast(f"array<array<{kind}>>").alias("out"))
        block = lambda s, i: F.aggregate(F.slice(v, i * size + 1, size), state(s, empty), one, lambda r: state(r, F.concat(s["out"], F.array(r["out"]))))
        return F.aggregate(blocks, first, block, lambda s: finish(s, F.flatten(s["out"])))

    return T.let(values, of)


def units(pages: Column, *, longest: int = LONGEST, paragraph_break: str = r"(?U)\n\s*\n+", clean: bool = True) -> Column:
    """array<struct<text, page, section>> of array<string> pages: paragraphs, long ones by sentence.

    A title paragraph is no unit; it names the section of the units after it, across pages.
    """

    def of_page(page: Column, i: Column) -> Column:
        body = T.normalize_page(page) if clean else F.coalesce(page, F.lit(""))
        return F.transform(T.paragraphs(body, paragraph_break), lambda p: F.struct(p.alias("text"), (i + 1).cast("int").alias("page")))

    def parts(p: Column, section: Column) -> Column:
        unit = lambda text: F.struct(text.alias("text"), p["page"].alias("page"), section.alias("section"))
        return F.when(F.char_length(p["text"]) > longest, F.transform(T.sentences(p["text"]), unit)).otherwise(F.array(unit(p["text"])))

    def step(s: Column, p: Column, following: Callable) -> Column:
        return F.when(T.is_title(p["text"]), following({"section": T.section_title(p["text"])})).otherwise(following({"section": s["section"]}, parts(p, s["section"])))

    # Without a title nothing is carried from one paragraph to the next.
    none = F.lit(None).cast("string")
    titled = lambda v: _folded(v, {"section": none}, step, _UNIT, lambda s, out: out)
    untitled = lambda v: F.flatten(F.transform(v, lambda p: parts(p, none)))
    paragraphs = F.flatten(F.transform(F.coalesce(pages, F.array().cast("array<string>")), of_page))
    return T.let(paragraphs, lambda v: F.when(F.exists(v, lambda p: T.is_title(p["text"])), titled(v)).otherwise(untitled(v)))


def packed(unit_array: Column, *, target: int = TARGET, least: int = LEAST, overlap: int = OVERLAP) -> Column:
    """array<struct<text, page_start, page_end, section>>: units packed greedily, each chunk beginning with the last one's tail.

    A chunk closes before a unit that would take it over `target`, if it has
    `least` characters, separators counted. See orphan_merged() for the last one.
    """
    chunk = lambda s: F.struct(T.stripped(s["text"]).alias("text"), s["low"].alias("page_start"), s["high"].alias("page_end"), s["section"].alias("section"))

    def step(s: Column, u: Column, following: Callable) -> Column:
        def fields(text: Column, size: Column, low: Column, high: Column, section: Column) -> dict[str, Column]:
            return {
                "len": (size + F.char_length(u["text"]) + 1).cast("int"),
                "text": F.concat_ws(" ", text, u["text"]),
                "low": F.coalesce(F.least(low, u["page"]), u["page"]),
                "high": F.coalesce(F.greatest(high, u["page"]), u["page"]),
                "last": u["page"],
                "section": section,
            }

        # Either state as a whole, so that what decides between them is asked once a unit.
        tail = F.substring(s["text"], -overlap, overlap) if overlap else F.lit(None).cast("string")
        page = s["last"] if overlap else u["page"]
        next_chunk = following(fields(tail, F.coalesce(F.char_length(tail), F.lit(0)), page, page, F.coalesce(u["section"], s["section"])), F.array(chunk(s)))
        same_chunk = following(fields(s["text"], s["len"], s["low"], s["high"], F.coalesce(s["section"], u["section"])))
        return F.when((s["len"] + F.char_length(u["text"]) > target) & (s["len"] >= least), next_chunk).otherwise(same_chunk)

    none = lambda kind: F.lit(None).cast(kind)
    start = {"len": F.lit(0), "text": none("string"), "low": none("int"), "high": none("int"), "last": none("int"), "section": none("string")}
    # Chunks without text, such as the one before the first unit, go at the end.
    return _folded(unit_array, start, step, _CHUNK, lambda s, out: F.filter(F.concat(out, F.array(chunk(s))), lambda c: c["text"] != ""))


def orphan_merged(every: Column, least: int = LEAST) -> Column:
    """Packed chunks, of which a last one under `least` characters joins the one before, overlap and all."""
    last, before = F.element_at(every, -1), F.get(every, F.size(every) - 2)
    both = F.struct(F.concat(before["text"], F.lit(" "), last["text"]).alias("text"), before["page_start"].alias("page_start"), F.greatest(before["page_end"], last["page_end"]).alias("page_end"), before["section"].alias("section"))
    # A slice needs a length of zero or more even where it isn't taken.
    head = F.slice(every, 1, F.greatest(F.lit(0), F.size(every) - 2))
    small = (F.size(every) >= 2) & (F.char_length(F.get(every, F.size(every) - 1)["text"]) < least)
    return F.when(small, F.concat(head, F.array(both))).otherwise(every)


def chunk_documents(docs: DataFrame, id_col: str = "document_id", pages_col: str = "pages", **options) -> DataFrame:
    """A row for each chunk: chunk_id, document_id, text, char_count, token_estimate, page_start, page_end, position_in_doc, section_title_raw, total_in_doc.

    Documents without text give no rows; nulls count as no pages.
    """
    pack = {k: options.pop(k) for k in ("target", "least", "overlap") if k in options}
    # A projection for each step: what a later one reads more than once is computed once.
    rows = docs.select(F.col(id_col).alias("document_id"), units(F.col(pages_col), **options).alias("units"))
    rows = rows.select("document_id", packed(F.col("units"), **pack).alias("every"))
    rows = rows.select("document_id", orphan_merged(F.col("every"), pack.get("least", LEAST)).alias("chunks"))
    # posexplode would filter on the size of chunks, and so make them a second time.
    # The size is taken before: after, each of a document's rows would hold all its chunks until then, and so bytes by the square of their number.
    rows = rows.select("document_id", "chunks", F.size("chunks").alias("total_in_doc"))
    rows = rows.select("document_id", "total_in_doc", F.posexplode_outer("chunks").alias("position_in_doc", "c")).where("position_in_doc is not null")
    return rows.select(
        F.format_string("%s_%04d", F.col("document_id").cast("string"), "position_in_doc").alias("chunk_id"),
        "document_id",
        F.col("c.text").alias("text"),
        F.char_length("c.text").alias("char_count"),
        T.token_estimate(F.col("c.text")).alias("token_estimate"),
        F.col("c.page_start").alias("page_start"),
        F.col("c.page_end").alias("page_end"),
        "position_in_doc",
        F.col("c.section").alias("section_title_raw"),
        "total_in_doc",
    )


def sheet_cells(wide: DataFrame, date_col: str | None = None, *, least: int = 10) -> DataFrame:
    """(chunk_date, header, text): a wide narrative sheet as one row for each cell.

    The date column is the first whose name holds "fecha", else the first. Rows
    without a date and cells under `least` characters are left out.
    """
    date = date_col or next((c for c in wide.columns if "fecha" in c.lower()), wide.columns[0])
    rest = [c for c in wide.columns if c != date]
    as_text = lambda c: F.date_format(c, "yyyy-MM-dd") if dict(wide.dtypes)[c] in ("date", "timestamp") else F.trim(F.col(c).cast("string"))
    rows = wide.select(as_text(date).alias("chunk_date"), *[as_text(c).alias(c) for c in rest]).where("chunk_date is not null and chunk_date <> ''")
    return rows.unpivot("chunk_date", rest, "header", "text").where(F.char_length("text") >= least)


def is_header(cells: Column) -> Column:
    """Whether two or more cells of a row aren't blank: the first such row of a sheet is its header."""
    return F.size(F.filter(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")) >= 2


def header_row(rows: DataFrame, index_col: str = "row", cells_col: str = "cells") -> DataFrame:
    """(header_row, cells): the header of a sheet."""
    return rows.where(is_header(F.col(cells_col))).agg(F.min(index_col).alias("header_row"), F.min_by(cells_col, index_col).alias("cells")).where("header_row is not null")
