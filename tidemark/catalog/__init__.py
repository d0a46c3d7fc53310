"""Queries over the driver tables, each next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, path: str) -> DataFrame:
            return fn(configure(spark), path)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return run

    return register


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


for _module in ("cleansing", "storage", "quality", "dedup", "dimensions", "facts", "ledger", "operational", "jobs", "layout"):
    import_module(f"tidemark.catalog.{_module}")
