"""Registry of the runnable queries and, where SQL can say the same, their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onefold.workload.roles import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def listed(*names: str) -> dict:
    """List columns as text, for comparing."""
    return {n: F.array_join(n, "|") for n in names}


def big(column):
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")
