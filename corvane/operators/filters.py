"""Search filters as columns over chunks joined with their documents."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date forms of file names.
FILENAME_DATE = r"(?:^|[^0-9])(?:(\d{4})[._/-](\d{2})[._/-](\d{2})|(\d{2})[._/-](\d{2})[._/-](\d{2}))(?:[^0-9]|$)"


def effective_year() -> Column:
    """The chunk's own year, else its document's."""
    return F.coalesce(F.year("chunk_date"), F.col("document_year"))


def effective_month(*, filenames: bool = True) -> Column:
    """The month of the chunk's date, else of the document's date (ISO or day first), else of the file name."""
    date, name = F.col("document_date"), F.coalesce("filename", F.lit(""))
    of = lambda p, i, x: F.regexp_extract(x, p, i).try_cast("int")
    found = F.coalesce(
        F.month("chunk_date"),
        F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring(date, 6, 2).try_cast("int")),
        F.when(date.rlike(r"^\d{2}[._/-]\d{2}[._/-]\d{2,4}$"), of(r"^\d{2}[._/-](\d{2})", 1, date)),
    )
    return F.coalesce(found, of(FILENAME_DATE, 2, name), of(FILENAME_DATE, 5, name)) if filenames else found


def matches_exact_date(day: str) -> Column:
    """After recall: the chunk's date where it has one, else the document's date."""
    return F.coalesce(F.when(F.col("chunk_date").isNotNull(), F.col("chunk_date").cast("string") == day).otherwise(F.col("document_date") == day), F.lit(False))


def any_key(m: Column, names: list[str]) -> Column:
    return F.arrays_overlap(F.map_keys(m), F.array(*map(F.lit, names)))


def search_filter(parsed: dict) -> Column:
    """The predicate of a parsed query, the same for every recall; no filters let all pass."""
    out = F.lit(True)
    if parsed.get("exact_date"):
        out &= (F.col("chunk_date") == F.lit(parsed["exact_date"]).cast("date")) | (F.col("document_date") == parsed["exact_date"])
    if parsed.get("doc_types"):
        out &= F.col("doc_type_category").isin(*parsed["doc_types"])
    if parsed.get("year_from") is not None:
        out &= effective_year() >= parsed["year_from"]
    if parsed.get("year_to") is not None:
        out &= effective_year() <= parsed["year_to"]
    if parsed.get("sections"):
        out &= F.col("section_type").isin(*parsed["sections"])
    if parsed.get("variables"):
        out &= any_key(F.col("economic_variables"), parsed["variables"]) | (F.col("section_type") == "DECISION")
    return out


def _listed(x) -> list:  # noqa: ANN001
    return [] if x is None else list(x) if isinstance(x, list | tuple | set) else [x]


@dataclass
class AdvancedFilters:
    """Explicit filters; empty lists don't filter. Entities must all occur unless entities_any is set."""

    years: list[int] = field(default_factory=list)
    months: list[int] = field(default_factory=list)
    institutions: list[str] = field(default_factory=list)
    exclude_institutions: list[str] = field(default_factory=list)
    doc_types: list[str] = field(default_factory=list)
    exclude_doc_types: list[str] = field(default_factory=list)
    entities: list[str] = field(default_factory=list)
    entities_any: bool = False
    tags: list[str] = field(default_factory=list)
    min_importance: float = 0.0
    max_importance: float = 1.0
    min_confidence: float = 0.0
    exclude_boilerplate: bool = False

    @classmethod
    def from_dict(cls, values: dict) -> AdvancedFilters:
        """Scalars stand for lists of one; unknown keys are refused."""
        known = {f.name: f for f in fields(cls)}
        if extra := set(values) - set(known):
            raise ValueError(f"unknown filters: {', '.join(sorted(extra))}")
        return cls(**{k: _listed(v) if known[k].default_factory is list else v for k, v in values.items() if v is not None})

    @classmethod
    def load(cls, path: str) -> AdvancedFilters:
        return cls.from_dict(json.loads(Path(path).read_text()))

    def to_dict(self) -> dict:
        return asdict(self)

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(self.to_dict(), ensure_ascii=False, indent=2))

    def active(self) -> int:
        """How many filters do something."""
        plain = AdvancedFilters()
        return sum(getattr(self, f.name) != getattr(plain, f.name) for f in fields(self) if f.name != "entities_any")

    def predicate(self) -> Column:
        """What is decided before recall."""
        out = F.col("importance_score").between(self.min_importance, self.max_importance)
        if self.years:
            out &= effective_year().isin(*self.years)
        if self.institutions:
            out &= F.col("institution").isin(*self.institutions)
        if self.exclude_institutions:
            out &= ~F.col("institution").isin(*self.exclude_institutions)
        if self.doc_types:
            out &= F.col("doc_type_category").isin(*self.doc_types)
        if self.exclude_doc_types:
            out &= ~F.col("doc_type_category").isin(*self.exclude_doc_types)
        if self.entities:
            has = [F.map_contains_key("entities", F.lit(e)) for e in self.entities]
            both = has[0]
            for h in has[1:]:
                both = both | h if self.entities_any else both & h
            out &= both
        if self.tags:
            out &= F.arrays_overlap("tags", F.array(*map(F.lit, self.tags)))
        if self.min_confidence > 0:
            out &= F.col("section_confidence") >= self.min_confidence
        if self.exclude_boilerplate:
            out &= F.col("importance_score") > 0
        return out

    def after_recall(self) -> Column:
        """What is decided on the recalled rows: months, and importance and confidence again."""
        out = F.col("importance_score").between(self.min_importance, self.max_importance) & (F.coalesce("section_confidence", F.lit(0.0)) >= self.min_confidence)
        return out & F.coalesce(effective_month(filenames=False).isin(*self.months), F.lit(False)) if self.months else out
