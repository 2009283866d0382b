"""Top-k products from activity counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketstream.functions import times


def top_k(counts: DataFrame, within: Sequence[str] = ("window", "user_id"), k: int = 5) -> DataFrame:
    """The ``k`` products with the highest ``n`` in each group, with their ``rank``; ties go by product id.

    ``row_number() <= k`` lets Spark cut every task's share of a group to k rows before the shuffle, so a group
    that holds most of the counts still sends at most k rows per task.
    """
    order = W.partitionBy(*within).orderBy(F.desc("n"), F.asc("product_id"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def as_lists(ranked: DataFrame, within: Sequence[str] = ("window", "user_id")) -> DataFrame:
    """One row per group with ``product_ids`` in rank order (at most k, as ``top_k`` left them)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "product_id")))
    return ranked.groupBy(*within).agg(F.transform(ordered, lambda e: e["product_id"]).alias("product_ids"))


def recommendations(lists: DataFrame) -> DataFrame:
    """Add the window's bounds and the processing time."""
    return lists.select(
        *[c for c in lists.columns if c not in ("window", "product_ids")],
        "product_ids",
        times.format_rfc3339(F.current_timestamp()).alias("generated_at"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def as_messages(recommended: DataFrame) -> DataFrame:
    """Messages keyed by user; the value has the reader's three fields and the window's bounds."""
    record = F.struct(
        "user_id",
        "product_ids",
        "generated_at",
        times.format_rfc3339(F.col("window_start")).alias("window_start"),
        times.format_rfc3339(F.col("window_end")).alias("window_end"),
    )
    return recommended.select(F.col("user_id").alias("key"), F.to_json(record).alias("value"))
