"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .standins_sql import with_relations

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _in_utc(fn: Query) -> Query:
    """Dates are cut from timestamps in UTC, whatever the session was built with."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the stand-in relations by name."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = _in_utc(fn)
        if sql is not None:
            ORACLES[name] = with_relations(sql)
        return fn

    return wrap
