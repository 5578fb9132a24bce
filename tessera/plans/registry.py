"""All registered queries and their DuckDB oracle SQL, by name."""

from __future__ import annotations

from tessera.plans import classify_queries, job_queries, selection_queries, sheet_queries

_MODULES = [sheet_queries, classify_queries, selection_queries, job_queries]


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
