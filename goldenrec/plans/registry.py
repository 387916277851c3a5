"""Query registry: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query and (optionally) its oracle SQL under ``name``."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


def initcap_sql(x: str) -> str:
    """Spark initcap in DuckDB: lower everything, upper the first letter of
    each space-separated word."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
