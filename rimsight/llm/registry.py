"""Queries of this subpackage and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its SQL."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
