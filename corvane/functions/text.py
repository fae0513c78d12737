"""Text functions as columns: everything here stays inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name parts, months, markers and patterns that results depend on.
PROTECTED_MARKERS = ("Microsoft Azure Information Protection", "This is a protected document", "You can view it using a supported PDF reader")
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
TITLE = r"^([A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ\s]{2,60})\s*$"
SENTENCE_BREAK = r"(?<=[.!?])\s+(?=[A-ZÁÉÍÓÚÑ0-9])"
YEAR = r"\b(19[8-9]\d|20[0-4]\d)\b"
QUARTER = r"(?i)\b(q[1-4]|[1-4][ºo]?\s*trimestre)\b"
NUMERIC = (
    (r"(\d{1,3}(?:[.,]\d{1,3})?)\s*(?:%|por ciento|percent)", "percentage"),
    (r"(\d{1,4})\s*(?:puntos base|pb\b|bps\b|basis points)", "basis_points"),
    (r"(\d{1,4}(?:[.,]\d{1,3})*)\s*(billones?|billion)", "billions"),
    (r"(\d{1,4}(?:[.,]\d{1,3})*)\s*(millones?|million)", "millions"),
    (r"(?:USD|US\$|\$)\s*(\d{1,4}(?:[.,]\d{1,3})*)", "usd_amount"),
)


#: What (?U)\s stands for in a pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _accent_table() -> tuple[str, str]:
    """Letters that decompose to one letter and marks, and that letter; by rule, over the Latin blocks. Marks alone go."""
    of, to = [], []
    for x in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(c for c in unicodedata.normalize("NFD", chr(x)) if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != chr(x):
            of.append(chr(x))
            to.append(plain)
    return "".join(of) + "".join(map(chr, range(0x300, 0x370))), "".join(to)


ACCENTED, PLAIN = _accent_table()


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip_accents(x: Column) -> Column:
    """Latin letters without their accents; letters that don't decompose stay. Texts of single bytes only have none, and aren't looked through by letter."""
    return F.when(F.octet_length(x) == F.char_length(x), x).otherwise(F.translate(x, ACCENTED, PLAIN))


def normalize_text(x: Column) -> Column:
    """Lower case, no accents, white space as single spaces."""
    # Single spaces, which are most of the white space, stay as they are without being replaced.
    return F.trim(F.regexp_replace(strip_accents(F.lower(x)), r"(?U) \s+|[^\S ]\s*", " "))


def normalized(text: str) -> str:
    """normalize_text() of a Python string."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
    return re.sub(r"\s+", " ", plain).strip()


def quoted(text: str) -> str:
    """A literal inside a pattern that Java and Python read alike."""
    return re.sub(r"([^a-z0-9 ])", r"\\\1", text)


def word_pattern(words: Iterable[str]) -> str:
    """Whole words of normalised text, the first that fits in list order; no words match nothing.

    The first characters are asked for before anything else, which most places in a text fail at once.
    """
    some = [quoted(normalized(w)) for w in words if w.strip()]
    if not some:
        return r"(?!)"
    first = "".join(sorted({re.match(r"\\?.", w)[0] for w in some}))
    return rf"(?=[{first}])(?<![a-z0-9])(?:" + "|".join(some) + r")(?![a-z0-9])"


def mentions(normal: Column, words: Iterable[str]) -> Column:
    """How often any of the words occurs, without overlaps."""
    return F.regexp_count(normal, F.lit(word_pattern(words)))


def normalize_page(x: Column) -> Column:
    """Joins words divided at line ends, turns single line ends into spaces, collapses blanks, drops page numbers and watermarks, in this order."""
    x = F.regexp_replace(x, r"(?U)-\n(\w)", "$1")
    x = F.regexp_replace(x, r"(?<!\n)\n(?!\n)", " ")
    x = F.regexp_replace(x, r"[ \t]+", " ")
    x = F.regexp_replace(x, r"(?mdU)^\s*\d{1,3}\s*$", "")
    x = F.regexp_replace(x, r"\{\[\{[^}]*\}\]\}", "")
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)^\s+|\s+$", "")


def stripped(x: Column) -> Column:
    """Without the white space at both ends, all of Unicode's; only the ends are looked at, not every space between."""
    return F.trim(x, F.lit(WHITE))


def paragraphs(x: Column, pattern: str = r"(?U)\n\s*\n+") -> Column:
    return F.filter(F.transform(F.split(x, pattern), stripped), lambda p: p != "")


def sentences(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, "(?U)" + SENTENCE_BREAK), stripped), lambda s: s != "")


def is_title(x: Column) -> Column:
    """Whether a paragraph is a title: short, one line, upper case."""
    return (F.char_length(x) <= 80) & ~F.contains(x, F.lit("\n")) & x.rlike(TITLE)


def section_title(x: Column) -> Column:
    """The title, if a paragraph is one; else null."""
    return F.when(is_title(x), stripped(F.regexp_extract(x, TITLE, 1)))


def slug(path: Column) -> Column:
    """A path without its extension, lower case, other characters as single underscores."""
    base = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"(?<=[^/])\.[^./]+$", "")
    return F.trim(F.regexp_replace(F.lower(base), r"[^a-z0-9]+", "_"), F.lit("_"))


def _slashed(path: Column) -> Column:
    return F.lower(F.replace(path, F.lit("\\"), F.lit("/")))


def document_type(path: Column) -> Column:
    p = _slashed(path)
    return (
        F.when(p.contains("comunicado"), "COMUNICADO")
        .when(p.contains("minuta"), "MINUTA")
        .when(p.contains("/fed/") | p.startswith("fed/") | p.contains("reunion_fed"), "FED_STATEMENT")
        .when(p.contains("monitor_pm") | p.contains("monitor pm"), "MONITOR_PM")
        .otherwise("REPORTE_RESEARCH")
    )


def institution(path: Column) -> Column:
    p = _slashed(path)
    chile = p.contains("comunicado") | p.contains("minuta") | p.contains("monitor_pm") | p.contains("monitor pm")
    return F.when(p.contains("jpm"), "jpmorgan").when(p.contains("fed"), "federal_reserve").when(chile, "banco_central_chile").otherwise("unknown")


def detect_date(filename: Column, first_page: Column, *, short_years: bool = True) -> Column:
    """A date in a file name or the first 500 characters: year first, day first, Spanish month names, else a bare year.

    Dates aren't validated. Two-digit years under 50 are 20xx; short_years=False leaves them out.
    """
    x = F.concat(F.coalesce(filename, F.lit("")), F.lit(" "), F.substring(F.coalesce(first_page, F.lit("")), 1, 500))
    split = "[._/-]"
    part = lambda p, i: F.regexp_extract(x, p, i).try_cast("int")
    iso = lambda y, m, d: F.format_string("%04d-%02d-%02d", y, m, d)
    year_first = rf"(\d{{4}}){split}(\d{{1,2}}){split}(\d{{1,2}})"
    day_first = rf"(\d{{1,2}}){split}(\d{{1,2}}){split}(\d{{{'2,' if short_years else ''}4}})"
    named = rf"(?i)(\d{{1,2}})\s+de\s+({'|'.join(MONTHS)})\s+de\s+(\d{{4}})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(x, named, 2))).cast("int")
    year = part(day_first, 3)
    year = F.when(year < 50, year + 2000).when(year < 100, year + 1900).otherwise(year)
    return (
        F.when(x.rlike(year_first), iso(part(year_first, 1), part(year_first, 2), part(year_first, 3)))
        .when(x.rlike(day_first), iso(year, part(day_first, 2), part(day_first, 1)))
        .when(x.rlike(named), iso(part(named, 3), month, part(named, 1)))
        .when(x.rlike(r"\b(19\d{2}|20\d{2})\b"), F.regexp_extract(x, r"\b(19\d{2}|20\d{2})\b", 1))
    )


def numeric_values(x: Column, patterns: tuple = NUMERIC, most: int = 10) -> Column:
    """array<struct<value, unit, raw>> of numbers in patterns' order; the first of each value and unit, `most` at most."""

    def of(pattern: str, unit: str) -> Column:
        both = F.arrays_zip(F.regexp_extract_all(x, F.lit(pattern), 1).alias("value"), F.regexp_extract_all(x, F.lit(pattern), 0).alias("raw"))
        return F.transform(both, lambda z: F.struct(z["value"].alias("value"), F.lit(unit).alias("unit"), stripped(z["raw"]).alias("raw")))

    found = [of(p, unit) for p, unit in patterns]
    every = F.coalesce(F.concat(*found), F.array().cast("array<struct<value:string,unit:string,raw:string>>"))

    def first(e: Column) -> Column:
        distinct = F.slice(F.array_distinct(F.transform(e, lambda a: F.struct(a["value"].alias("value"), a["unit"].alias("unit")))), 1, most)
        return F.transform(distinct, lambda d: F.get(F.filter(e, lambda a: (a["value"] == d["value"]) & (a["unit"] == d["unit"])), F.lit(0)))

    # Most texts have no number, and are looked through once for each pattern.
    some = reduce(or_, [x.rlike(p) for p, _ in patterns], F.lit(False))
    return F.when(some, let(every, first)).otherwise(F.array().cast("array<struct<value:string,unit:string,raw:string>>"))


def temporal_refs(x: Column) -> Column:
    """struct<years, quarters>: sorted distinct matches, null where there are none."""

    def some(pattern: str) -> Column:
        return let(F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), 1))), lambda found: F.when(F.size(found) > 0, found))

    return F.struct(some(YEAR).alias("years"), some(QUARTER).alias("quarters"))


def token_estimate(x: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.char_length(x) / 4)).cast("int")


def lexemes(x: Column) -> Column:
    """Lower-case runs of letters and digits, accents kept, in order."""
    return F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), lambda t: t != "")
