"""Where the queries and their SQL are kept."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query under its key, with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
