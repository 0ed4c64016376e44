"""Named checks: a Spark query over the test tables and, where SQL can say it, its oracle."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Common table expressions for the oracles, in an order in which each may use earlier ones.
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def _needed(sql: str) -> set[str]:
    found = {name for name in CTES if re.search(rf"\b{name}\b", sql)}
    return found.union(*(_needed(CTES[name]) for name in found)) if found else found


def with_ctes(sql: str) -> str:
    """``sql`` behind a WITH clause that defines exactly the expressions it needs."""
    needed = _needed(sql)
    if not needed:
        return sql
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def check(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key``, with its oracle if it has one."""

    def register(query: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered already")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = with_ctes(sql)
        return query

    return register
