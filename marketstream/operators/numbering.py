"""Consecutive row numbers without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


RANGE = 1 << 16


def before(
    totals: DataFrame, keys: Sequence[str], at: str, value: str, combine: Callable[[Column | str], Column], name: str,
    levels: int = 2, width: int = RANGE,
) -> DataFrame:
    """Add ``name``: ``value`` of the rows with a smaller ``at``, combined within ``keys``; null where there are none.

    ``at`` is unique within ``keys``, from 0 and below ``width ** levels``; anything else is an error. Ranges of ``width`` run side
    by side, then the ranges' own values in ranges of ranges, so no task orders more than ``width`` rows of a key.
    """
    part = F.floor(F.col(at) / F.lit(width)).cast("bigint")
    if levels == 1:
        part = F.when(part == 0, part).otherwise(F.raise_error(F.lit(f"{at} is out of range")).cast("bigint"))
    cut = totals.withColumn("_range", part)
    within = W.partitionBy(*keys, "_range").orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    local = cut.withColumn(name, combine(value).over(within))
    if levels == 1:
        return local.drop("_range")
    ranges = cut.groupBy(*keys, "_range").agg(combine(value).alias("_all"))
    earlier = before(ranges.withColumnRenamed("_range", "_at"), keys, "_at", "_all", combine, f"_earlier{levels}", levels - 1, width)
    same = F.expr(" AND ".join([f"l.`{c}` <=> e.`{c}`" for c in keys] + ["l._range = e._at"]))
    both = local.alias("l").join(earlier.alias("e"), same).select("l.*", f"e._earlier{levels}")
    # Nulls fall out of an array of the two, so a missing one changes nothing.
    parts = F.filter(F.array(name, f"_earlier{levels}"), lambda v: v.isNotNull())
    joined = F.when(F.size("_parts") == 2, _two(combine, F.col("_parts"))).otherwise(F.get("_parts", F.lit(0)))
    return both.withColumn("_parts", parts).withColumn(name, joined).drop("_range", f"_earlier{levels}", "_parts")


def _two(combine: Callable, parts: Column) -> Column:
    if combine is F.max:
        return F.array_max(parts)
    if combine is F.min:
        return F.array_min(parts)
    if combine is F.sum:
        return F.get(parts, F.lit(0)) + F.get(parts, F.lit(1))
    raise ValueError("combine with max, min or sum")


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "offset", width: int = 1_000_000, start: int = 0
) -> DataFrame:
    """Number rows from ``start`` by the integer column ``order`` within ``keys`` (or over all rows).

    Rows are cut into buckets of ``width`` consecutive order values. Each bucket is numbered on its own and
    shifted by the count of the buckets before it, so a task sorts at most ``width`` distinct order values
    however large the group is. The per-bucket counts are summed in ranges of buckets, counted from the first one.
    """
    cut = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(width)).cast("bigint"))
    group = [*keys, "_bucket"]
    # Moved up, so that negative buckets count from 0 too.
    sizes = cut.groupBy(*group).agg(F.count("*").alias("_n")).withColumn("_nth", F.col("_bucket") + F.lit(RANGE**3 // 2))
    bases = before(sizes, keys, "_nth", "_n", F.sum, "_base", levels=3).select(*group, F.coalesce("_base", F.lit(0)).alias("_base"))
    local = cut.withColumn("_row", F.row_number().over(W.partitionBy(*group).orderBy(order)))
    return (
        local.alias("l")
        .join(bases.alias("b"), F.expr(" AND ".join(f"l.`{c}` <=> b.`{c}`" for c in group)))
        .select("l.*", "b._base")
        .withColumn(name, (F.col("_base") + F.col("_row") - 1 + start).cast("bigint"))
        .drop("_bucket", "_row", "_base")
    )
