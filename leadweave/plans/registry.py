"""The queries of the core, by name, and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a ``(spark, folder) -> DataFrame`` under its name, with the SQL that says the same."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put
