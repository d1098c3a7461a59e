"""Registry of named queries: ``name -> (spark_fn(spark, sf_dir), oracle SQL or None)``.

Query modules call :func:`register`; :func:`queries` / :func:`oracle_sql`
import them all and return the two maps used by ``__spark_entry__``.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}

_MODULES = [
    "tidemark.plans.market_queries",
    "tidemark.plans.text_queries",
    "tidemark.plans.table_queries",
    "tidemark.plans.model_queries",
]


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
