"""Rows side by side with the next row of a global order, at the price of one shuffle."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket on average, and the bound of the number of buckets, so of what is broadcast: one small row per bucket.
ROWS = 512
MOST_BUCKETS = 1 << 16


def bucketed(rows: DataFrame, order: str, size: int = ROWS) -> DataFrame:
    """Add ``_bucket``: consecutive ranges of the numeric column ``order`` with about equal numbers of rows."""
    n = min(MOST_BUCKETS, max(1, rows.count() // size))
    at = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = rows.select(F.percentile_approx(order, shares, 4 * n + 100).alias("cuts")).first()["cuts"] or [0]
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    found = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket").transform(rows.withColumn("_at", at))
    return found.drop("_at").withColumn("_bucket", F.col("_bucket").cast("int"))


def with_next(rows: DataFrame, order: str, value: str, size: int = ROWS) -> DataFrame:
    """``rows`` with ``next``: ``value`` of the next row by descending ``order``; after the last row follows the first.

    Ties are ordered by the hash of ``value``, nulls come last. Also added: ``_bucket``, ``_place`` within it (the order),
    and ``_guest``: a bucket ends with a copy of the row that follows it, which is a guest there and has no ``next`` of
    its own. The result is hash-partitioned by ``_bucket``.
    """
    tied = bucketed(rows, order, size).withColumn("_tie", F.xxhash64(value))
    heads = tied.groupBy("_bucket").agg(F.max(F.struct(F.col(order), F.col("_tie"))).alias("head"))
    # One row per bucket: their number is bounded, so they may meet in one task and be broadcast.
    falling = Window.orderBy(F.desc("_bucket"))
    ends = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    host = F.coalesce(F.lag("_bucket").over(falling), F.last("_bucket").over(ends))
    heads = heads.select(
        F.col("_bucket").alias("_b"), host.alias("_host"), F.col(f"head.{order}").alias("_first"), F.col("head._tie").alias("_first_tie")
    )
    is_head = (F.col("_bucket") == F.col("_b")) & F.col(order).eqNullSafe(F.col("_first")) & (F.col("_tie") == F.col("_first_tie"))
    both = tied.join(F.broadcast(heads), is_head, "left")
    stays = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest"))
    visits = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.when(F.col("_host").isNull(), F.array(stays)).otherwise(F.array(stays, visits))
    seated = both.withColumn("_seat", F.explode(seats)).select(
        *rows.columns, "_tie", F.coalesce("_seat.bucket", F.lit(0)).alias("_bucket"), F.col("_seat.guest").alias("_guest")
    )
    line = Window.partitionBy("_bucket").orderBy("_guest", F.desc_nulls_last(order), F.desc("_tie"))
    return seated.withColumn("next", F.lead(value).over(line)).withColumn("_place", F.row_number().over(line)).drop("_tie")
