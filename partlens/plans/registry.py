"""The register of queries: a function over ``Data`` and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partlens.plans.relations import Data, checker_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(data)`` under ``name``; ``check`` is the equivalent SQL."""

    def register(fn: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if check is not None:
            CHECKS[name] = checker_sql(check)
        return fn

    return register
