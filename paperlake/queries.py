"""Registry of the core queries and their DuckDB SQL."""

from __future__ import annotations

from .plans import collect, corpus, gates, joins, parsing, retrieval, texts, verify  # noqa: F401  (each registers its queries)
from .plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
