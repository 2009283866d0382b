"""Products against the banned categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.functions import text
from marketstream.operators import membership

PASSED, FILTERED = "PASSED", "FILTERED"


def _prepare(products: DataFrame, banned: DataFrame, normalise: bool) -> tuple[DataFrame, DataFrame]:
    key = text.normalise_category(F.col("category")) if normalise else F.col("category")
    names = text.normalise_category(F.col("category")) if normalise else F.col("category")
    return (
        products.withColumn("_category", key),
        banned.select(names.alias("_category")).filter(F.col("_category").isNotNull()).distinct(),
    )


def passed(products: DataFrame, banned: DataFrame, normalise: bool = False, small: bool | None = None) -> DataFrame:
    """Products whose category is not banned. The match is exact unless ``normalise``; no category passes."""
    left, right = _prepare(products, banned, normalise)
    return membership.join_set(left, right, "_category", "left_anti", small).drop("_category")


def filtered(products: DataFrame, banned: DataFrame, normalise: bool = False, small: bool | None = None) -> DataFrame:
    """The products ``passed`` leaves out."""
    left, right = _prepare(products, banned, normalise)
    return membership.join_set(left, right, "_category", "left_semi", small).drop("_category")


def audit(products: DataFrame, banned: DataFrame, normalise: bool = False, small: bool | None = None) -> DataFrame:
    """Every product with its ``status``, in one pass over the input."""
    left, right = _prepare(products, banned, normalise)
    marked = membership.join_set(left, right.withColumn("_hit", F.lit(True)), "_category", "left", small)
    status = F.when(F.col("_hit"), F.lit(FILTERED)).otherwise(F.lit(PASSED))
    return marked.withColumn("status", status).drop("_category", "_hit")


def audit_line(audited: DataFrame, topic_out: str = "products-filtered") -> DataFrame:
    """The log line of each screened product."""
    category = F.coalesce("category", F.lit(""))
    return audited.withColumn(
        "line",
        F.when(
            F.col("status") == FILTERED,
            F.format_string("FILTERED [%s] %s (category=%s): banned category", "id", "name", category),
        ).otherwise(F.format_string("PASSED  [%s] %s (category=%s) -> " + topic_out, "id", "name", category)),
    )


def tally(audited: DataFrame) -> DataFrame:
    return audited.groupBy("status", "category").agg(F.count("*").alias("n"))
