"""Collects the queries: name -> callable(spark, sf_dir), and name -> equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from tidemark.plans import (  # noqa: F401  (importing them fills the tables above)
        evaluation, features, monitoring, registry, scoring, streams, tables, training,
    )
    return QUERIES, SQL
