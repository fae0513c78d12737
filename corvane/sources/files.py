"""PDF and spreadsheet files to pages and cells, and documents from them.

The PDF reader needs pypdf on the executors; where it is missing,
each file gets a warning instead of an empty result without one.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators.chunking import chunk_documents
from corvane.operators.stats import document_totals
from corvane.plans.profiles import FULL, Profile
from corvane.sources.xlsx import narrative_cells, sheet_rows

PATTERN = "*.{pdf,xlsx,xls}"
#: Characters under which a document without other warnings counts as scanned.
SCANNED = 500


def discover(spark: SparkSession, folder: str, pattern: str = PATTERN) -> DataFrame:
    """(path, relative, filename, length, content) of the files under a folder. The content is only read where it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/")
    root = root.split("://", 1)[-1] if "://" in root else root
    relative = F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/"), "^/*" + T.quoted(root.lstrip("/")) + "/", "") if root else F.col("path")
    return files.select("path", relative.alias("relative"), F.element_at(F.split("path", "/"), -1).alias("filename"), "length", "content")


def _pdf_pages(content: bytes) -> tuple[list[str], list[str]]:
    try:
        from pypdf import PdfReader
    except ImportError:
        return [], ["pypdf is not installed"]
    try:
        reader = PdfReader(io.BytesIO(content))
        if reader.is_encrypted and not reader.decrypt(""):
            return [], ["the file is encrypted"]
        pages, warnings = [], []
        for i, page in enumerate(reader.pages, 1):
            try:
                pages.append(page.extract_text() or "")
            except Exception as e:  # noqa: BLE001  one damaged page doesn't lose the others
                pages.append("")
                warnings.append(f"page {i}: {e}")
        return pages, warnings
    except Exception as e:  # noqa: BLE001
        return [], [f"the file can't be read: {e}"]


def pdf_pages(files: DataFrame) -> DataFrame:
    """(path, relative, filename, pages array<string>, extraction_warnings): encrypted, protected and scanned files are warned of."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [_pdf_pages(bytes(c)) for c in batch["content"]]
            yield batch[["path", "relative", "filename"]].assign(pages=[g[0] for g in got], extraction_warnings=[g[1] for g in got])

    rows = files.where(F.lower("path").endswith(".pdf")).select("path", "relative", "filename", "content")
    return with_warnings(rows.mapInPandas(read, "path string, relative string, filename string, pages array<string>, extraction_warnings array<string>"))


def with_warnings(pages: DataFrame) -> DataFrame:
    """Adds the warnings that follow from the text: protection markers, and too little text if nothing else was warned of."""
    text = F.array_join("pages", "\n")
    marked = F.lit(False)
    for m in T.PROTECTED_MARKERS:
        marked |= text.contains(m)
    own = F.concat("extraction_warnings", F.when(marked, F.array(F.lit("protected document"))).otherwise(F.array().cast("array<string>")))
    scanned = (F.size(own) == 0) & (F.char_length(T.stripped(text)) < SCANNED)
    return pages.withColumn("extraction_warnings", F.concat(own, F.when(scanned, F.array(F.lit("little text: scanned?"))).otherwise(F.array().cast("array<string>"))))


def sheet_chunks(files: DataFrame, least: int = 10) -> DataFrame:
    """(path, relative, filename, sheet, chunk_date, section_title_raw, text, position_in_doc, warnings): a row for each narrative cell of each sheet.

    The header of a sheet is its first row with two filled cells. warnings is the file's; a file without such cells has one row without a text.
    """
    items = narrative_cells(sheet_rows(files.where(~F.lower("path").endswith(".pdf"))), least)
    file = Window.partitionBy("path")  # a file's cells, which were one row before
    items = items.select(
        "*",
        F.array_sort(F.collect_set("said").over(file)).alias("own"),
        F.count("text").over(file).alias("texts"),
        (F.row_number().over(file.orderBy(F.col("text").isNull(), "sheet", "row", "col")) - 1).cast("int").alias("position_in_doc"),
    )
    rows = items.where(F.col("text").isNotNull() | ((F.col("texts") == 0) & (F.col("position_in_doc") == 0)))
    warnings = F.when((F.col("texts") == 0) & (F.size("own") == 0), F.array(F.lit("no cells with text"))).otherwise(F.col("own"))
    of_text = lambda c: F.when(F.col("text").isNotNull(), F.col(c)).alias(c)
    return rows.select("path", "relative", "filename", of_text("sheet"), "chunk_date", "section_title_raw", "text", of_text("position_in_doc"), warnings.alias("warnings"))


def described(files: DataFrame, profile: Profile = FULL) -> DataFrame:
    """files(relative, filename), and pages if there are any, with document_id, type, institution and date."""
    page = F.get("pages", 0) if "pages" in files.columns else F.lit("")
    return files.withColumns({
        "document_id": T.slug(F.col("relative" if profile.path_ids else "filename")),
        "filepath": F.col("relative"),
        "doc_type_category": T.document_type(F.col("relative")),
        "institution": T.institution(F.col("relative")),
        "document_date": T.detect_date(F.col("filename"), page, short_years=profile.short_years),
    })


def extract(spark: SparkSession, folder: str, profile: Profile = FULL) -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) of all PDF files and spreadsheets under a folder."""
    files = discover(spark, folder)
    pages = described(pdf_pages(files), profile)
    of_pdf = chunk_documents(pages).withColumn("chunk_date", F.lit(None).cast("string"))
    cells = described(sheet_chunks(files), profile)
    of_sheet = cells.where("text is not null").select(
        F.format_string("%s_%04d", "document_id", "position_in_doc").alias("chunk_id"),
        "document_id",
        "text",
        F.char_length("text").alias("char_count"),
        T.token_estimate(F.col("text")).alias("token_estimate"),
        F.col("sheet").alias("page_start"),
        F.col("sheet").alias("page_end"),
        "position_in_doc",
        "section_title_raw",
        F.count("*").over(Window.partitionBy("document_id")).cast("int").alias("total_in_doc"),
        "chunk_date",
    )
    chunks = of_pdf.unionByName(of_sheet)
    named = ["document_id", "filename", "filepath", "doc_type_category", "institution"]
    sheets = cells.groupBy(*named).agg(F.min_by("chunk_date", "position_in_doc").alias("own_date"), F.coalesce(F.max("sheet"), F.lit(0)).alias("pages"), F.max("warnings").alias("extraction_warnings"), F.max("document_date").alias("name_date"))
    sheets = sheets.withColumn("own_date", F.coalesce("own_date", "name_date")).drop("name_date")
    papers = pages.select(*named, F.col("document_date").alias("own_date"), F.size("pages").alias("pages"), "extraction_warnings")
    totals = document_totals(chunks).select("document_id", "total_chunks", "char_count", F.col("document_date").alias("first_date"))
    documents = papers.unionByName(sheets).join(totals, "document_id", "left")
    return documents.select(*named, F.coalesce("own_date", "first_date").alias("document_date"), F.col("pages").alias("total_pages"), F.coalesce("total_chunks", F.lit(0)).cast("int").alias("total_chunks"), F.coalesce("char_count", F.lit(0)).alias("char_count"), "extraction_warnings"), chunks
