"""Named queries: a function of (spark, sf_dir) and, where there is one, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        n = name or f.__name__
        QUERIES[n] = f
        if sql is not None:
            SQL[n] = sql
        return f

    return add
