"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL equivalent."""

    def register(function: Query) -> Query:
        _queries[function.__name__] = function
        _sql[function.__name__] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
