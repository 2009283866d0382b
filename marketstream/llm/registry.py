"""What the driver's entry adds for the text operators: queries and the SQL that checks them."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from marketstream.llm import oracle
from marketstream.llm.queries import QUERIES, Query

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def _importable(query: Query) -> Query:
    """Python workers look for the package where the driver found it, unless they are told a place already."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(spark, sf_dir.rstrip("/"))

    return run


def queries() -> dict[str, Query]:
    return {name: _importable(query) for name, query in (QUERIES | {"pipeline": corpus_pipeline.run}).items()}


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
