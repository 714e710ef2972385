"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""

    def register(run: Query) -> Query:
        @wraps(run)
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
            return run(spark, folder)

        key = name or run.__name__
        QUERIES[key] = in_utc
        if sql:
            ORACLES[key] = sql
        return in_utc

    return register
