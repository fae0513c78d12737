"""The two configurations of the pipeline: which dates, identifiers and retrieval steps are in use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """What a configuration switches.

    short_years: file dates may have two-digit years. path_ids: identifiers come
    from whole relative paths, else from file names, which may collide.
    query_dates: queries may hold exact dates and months. domestic_guard: the
    domestic section needs an explicit phrase. reconcile: query vectors are cut or
    padded to the stored dimension, else another dimension is an error.
    fallback: an empty result falls back to importance. whole_sheets: reports show spreadsheet texts whole.
    """

    short_years: bool = True
    path_ids: bool = True
    query_dates: bool = True
    domestic_guard: bool = True
    reconcile: bool = True
    fallback: bool = True
    whole_sheets: bool = True
    dimension: int = 768
    prefix: str = ""


FULL = Profile()
BASIC = Profile(short_years=False, path_ids=False, query_dates=False, domestic_guard=False, reconcile=False, fallback=False, whole_sheets=False, dimension=1024)
