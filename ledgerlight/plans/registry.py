"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is a callable ``(spark, sf_dir) -> DataFrame``; its DuckDB
oracle SQL (if the operator is SQL-expressible) is registered next to it.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from . import retail, retail_choices, retail_more, retail_reports, retail_windows, feeds, clinical, ingest  # noqa: F401
