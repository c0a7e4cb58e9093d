"""Registry of the checked queries: name -> Spark callable, name -> DuckDB SQL."""

from __future__ import annotations

from darkroom.plans import backup_queries, catalogue_queries, ingest_queries, stack_queries

_MODULES = (stack_queries, catalogue_queries, backup_queries, ingest_queries)


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
