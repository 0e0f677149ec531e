"""Registered queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its own name."""

    def keep(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLE_SQL[build.__name__] = sql
        return build

    return keep
