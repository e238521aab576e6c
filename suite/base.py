"""Registration helpers shared by all query modules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adit.session import spread


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a callable (spark, sf_dir) -> DataFrame under a key, with its SQL if it has one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, fn, sql)
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def load_spread(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The same for queries that are all text work: a table in few splits is spread over the cores."""
    return spread(load(spark, sf_dir, table))


def sql_round(expr: str, digits: int) -> str:
    """DuckDB rounding of a double on its shortest decimal form, half away from zero, as Spark rounds."""
    return f"(CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,26)), {digits}) AS DOUBLE) + 0.0)"


def sql_plain(expr: str, digits: int = 4) -> str:
    """DuckDB text of a number without exponent and without trailing zeros: 0.0001, 0.5, 1.0."""
    return (
        f"regexp_replace(CAST(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(24,{digits})) AS VARCHAR), "
        r"'(\.\d+?)0+$', '\1')"
    )
