"""The query catalogue: each module maps the tables onto the domain, names its queries, and gives their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import calendar, checks, company, derivation, evaluation, figures, history, lines, listings, matching, packaged, placed, series, served, splits, streams, texts, wording

MODULES = (calendar, checks, company, derivation, evaluation, figures, history, lines, listings, matching, packaged, placed, series, served, splits, streams, texts, wording)


def queries() -> dict[str, Callable]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
