"""Rows of .xlsx workbooks: the sheets' XML read as streams from the zip archive, values as a reader sees them."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators.chunking import is_header

#: Rows of a sheet in one batch.
ROWS = 2000
# The format's built-in numbers for dates and times, and its first days.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
DAY_ZERO, DAY_ZERO_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
SCHEMA = "path string, relative string, filename string, sheet int, sheet_name string, row int, cells array<string>, warning string"


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _text(element: ElementTree.Element) -> str:
    """The text of runs, without the readings that are given for Asian scripts."""
    out = []
    for child in element:
        if _tag(child) == "t":
            out.append(child.text or "")
        elif _tag(child) == "r":
            out += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(out)


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, element in ElementTree.iterparse(f):
            if _tag(element) == "si":
                out.append(_text(element))
                element.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The numbers of the cell styles that show dates or times."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(DATE_FORMATS)
    for element in root.iter():
        if _tag(element) == "numFmt":
            shown = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|_.|\*.', "", element.get("formatCode", ""))
            if re.search(r"[dmyhs]", shown, re.IGNORECASE) and "general" not in shown.lower():
                dates.add(int(element.get("numFmtId")))
    styles = next((e for e in root if _tag(e) == "cellXfs"), [])
    return {i for i, e in enumerate(styles) if int(e.get("numFmtId", 0)) in dates}


def _sheets(book: zipfile.ZipFile) -> tuple[list[tuple[str, str]], datetime]:
    """(name, file in the archive) of each sheet in order, and day zero."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    first = any(_tag(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in root)
    of = lambda target: target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    found = [(e.get("name"), of(links[next(v for k, v in e.attrib.items() if k.endswith("}id"))])) for e in root.iter() if _tag(e) == "sheet"]
    return found, DAY_ZERO_1904 if first else DAY_ZERO


def _shown(kind: str, value: str | None, date: bool, zero: datetime, strings: list[str]) -> str:
    """A cell's value as text: dates as YYYY-MM-DD, times as HH:MM:SS, whole numbers without a point."""
    if value is None or value == "":
        return ""
    if kind == "s":
        return strings[int(value)].strip()
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "d":
        return value[:10]
    if kind != "n":
        return value.strip()
    number = float(value) if re.search(r"[.eE]", value) else int(value)
    if not date:
        return str(number)
    if 0 <= number < 1:
        return str((datetime(1, 1, 1) + timedelta(days=number)).time().replace(microsecond=0))
    if zero == DAY_ZERO and 1 <= number < 60:  # the format has a 29 February 1900
        number += 1
    return (zero + timedelta(days=number)).strftime("%Y-%m-%d")


def _column(reference: str) -> int:
    """The place of "BC12"'s column, from 0."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def rows_of(content: bytes) -> Iterator[tuple[int, str, int, list[str]]]:
    """(sheet from 1, its name, row from 0, cells) of a workbook, a row at a time; cells that are left out are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dates = _strings(book), _date_styles(book)
        sheets, zero = _sheets(book)
        for number, (name, file) in enumerate(sheets, 1):
            at = -1
            with book.open(file) as f:
                for _, element in ElementTree.iterparse(f):
                    if _tag(element) != "row":
                        continue
                    at = int(element.get("r", at + 2)) - 1
                    cells: list[str] = []
                    for cell in element:
                        place = _column(cell.get("r")) if cell.get("r") else len(cells)
                        cells += [""] * (place + 1 - len(cells))
                        kind = cell.get("t", "n")
                        parts = {_tag(e): e for e in cell}
                        value = _text(parts["is"]) if "is" in parts else parts["v"].text if "v" in parts else None
                        cells[place] = _shown(kind, value, int(cell.get("s", 0)) in dates, zero, strings)
                    yield number, name, at, cells
                    element.clear()


def sheet_rows(files: DataFrame) -> DataFrame:
    """(path, relative, filename, sheet, sheet_name, row, cells, warning) of workbooks: a row for each row of each sheet.

    A file that can't be read, or breaks off, has a row with a warning and without cells; one without any row at all has one, too. files: as discover() gives them; content is read by Spark, a
    file for each row, and sheets are parsed as streams, so what a task holds is a file and its shared strings.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["sheet", "sheet_name", "row", "cells", "warning"]
        for batch in batches:
            for path, relative, filename, content in zip(batch["path"], batch["relative"], batch["filename"], batch["content"]):
                of = lambda rows: pd.DataFrame(rows, columns=columns).assign(path=path, relative=relative, filename=filename)[["path", "relative", "filename", *columns]].astype({"sheet": "Int32", "row": "Int32"})  # noqa: B023, E731
                held, found, warning = [], 0, None
                try:
                    for number, name, at, cells in rows_of(bytes(content)):
                        held.append((number, name, at, cells, None))
                        found += 1
                        if len(held) == ROWS:
                            yield of(held)
                            held = []
                except Exception as e:  # noqa: BLE001  one damaged file doesn't lose the others
                    warning = f"the file can't be read: {e}"
                if warning or not found:
                    held.append((None, None, None, None, warning or "no cells with text"))
                yield of(held)

    # A batch is a file, so that a task holds one.
    return files.select("path", "relative", "filename", "content").mapInPandas(read, SCHEMA)


def narrative_cells(rows: DataFrame, least: int = 10) -> DataFrame:
    """(path, relative, filename, sheet, row, col, chunk_date, section_title_raw, text, said) of the cells under a sheet's header with `least` characters or more.

    The date column is the first with "fecha" in its header, else the first; rows without a date, and columns without a header, are left out. The text names
    the date and the column. Each sheet and each file that can't be read have a row without text, too, with what is to be said of it, if anything.
    """
    sheet = Window.partitionBy("path", "sheet")
    header = F.when(is_header(F.col("cells")), F.col("row"))
    marked = rows.select("*", F.min(header).over(sheet).alias("header_row"), F.min_by("cells", header).over(sheet).alias("names"), F.min("row").over(sheet).alias("top"))
    fecha = F.array_position(F.transform("names", lambda n: F.lower(n).contains("fecha")), True)
    marked = marked.withColumn("at", F.greatest(fecha - 1, F.lit(0)).cast("int"))
    date = F.coalesce(F.get("cells", F.col("at")), F.lit(""))
    kind = "struct<col:int,section_title_raw:string,cell:string,said:string>"
    none = F.lit(None).cast("string")
    said = F.coalesce("warning", F.when(F.col("header_row").isNull(), F.concat(F.lit("a sheet without a header: "), "sheet_name")))
    of_sheet = F.when(F.col("row").isNull() | (F.col("row") == F.col("top")), F.array(F.struct(F.lit(-1).alias("col"), none.alias("section_title_raw"), none.alias("cell"), said.alias("said")))).otherwise(F.array().cast(f"array<{kind}>"))
    every = F.transform("cells", lambda c, i: F.struct(i.alias("col"), F.coalesce(F.get("names", i), F.lit("")).alias("section_title_raw"), c.alias("cell"), none.alias("said")))
    found = F.filter(every, lambda x: (x["col"] != F.col("at")) & (x["section_title_raw"] != "") & (F.char_length(x["cell"]) >= least))
    body = F.when((F.col("row") > F.col("header_row")) & (date != ""), found).otherwise(F.array().cast(f"array<{kind}>"))
    items = marked.select("path", "relative", "filename", "sheet", "row", date.alias("date"), F.explode(F.concat(of_sheet, body)).alias("x"))
    text = F.concat(F.lit("["), "date", F.lit(" - "), "x.section_title_raw", F.lit("]\n"), "x.cell")
    return items.select("path", "relative", "filename", "sheet", "row", "x.col", F.when(F.col("x.cell").isNotNull(), F.col("date")).alias("chunk_date"), "x.section_title_raw", text.alias("text"), "x.said")
