"""Queries over the tables of a folder."""

from __future__ import annotations


def all_queries() -> dict:
    from leadweave.plans import contacts, records  # noqa: F401
    from leadweave.plans.registry import QUERIES

    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    from leadweave.plans.registry import SQL

    all_queries()
    return dict(SQL)
