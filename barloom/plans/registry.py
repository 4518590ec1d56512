"""All registered queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from barloom.plans import bar_queries, store_queries, stream_queries, wire_queries
from barloom.plans.results import comparable
from barloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
FAMILIES = (wire_queries, bar_queries, store_queries, stream_queries)


def _prepared(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(configure(spark), sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {name: _prepared(fn) for family in FAMILIES for name, fn in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for family in FAMILIES for name, text in family.ORACLE.items()}
