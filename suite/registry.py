"""Where the queries are listed."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quadrille.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

_HERE = str(Path(__file__).resolve().parent)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Lists a query; ``sql`` is the same result in ANSI SQL."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is listed twice")

        @wraps(run)
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark, _HERE)
            return run(spark, sf)

        QUERIES[name] = shipped
        if sql is not None:
            TWINS[name] = sql
        return run

    return add
