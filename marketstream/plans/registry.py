"""All queries by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from marketstream.plans import catalogue, monitoring, oracle, recommendations
from marketstream.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir.rstrip("/"))

    return run


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (recommendations, catalogue, monitoring):
        found |= {name: _prepared(query) for name, query in module.QUERIES.items()}
    return found


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
