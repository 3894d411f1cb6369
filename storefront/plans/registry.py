"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where there is one."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql.strip()
        return build

    return register
