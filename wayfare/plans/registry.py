"""Names of queries, the functions behind them and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with equivalent SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def sql_money_sum(column: str) -> str:
    """The sum as a warehouse with a numeric type gives it."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(38, 9))) AS DOUBLE)"
