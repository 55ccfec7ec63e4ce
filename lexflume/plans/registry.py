"""Registry of queries and the tables and views they run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None, views: tuple[str, ...] = ()) -> Callable:
    """Register a query under its function name, with the SQL of its result if there is one."""
    from lexflume.plans import fixtures

    def add(build: Callable[[fixtures.Views], DataFrame]) -> Callable:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(fixtures.Views(spark, folder))
        if sql is not None:
            ORACLES[name] = fixtures.with_views(views, sql)
        return build

    return add
