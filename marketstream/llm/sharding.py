"""Rendezvous hashing: each record goes to the shard that draws best for its key.

A draw depends on the key, the shard's number and its weight alone. With one more shard, the draws of the others stay, so
the only records that move are those that move into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import free_name

#: Places within a shard are given out in so many parts of the shard side by side.
PARTS = 4096


def draw(key: Column, shard: int, weight: float) -> Column:
    """Exponential with rate ``weight``: the smallest of several is shard i's with probability weight i over their sum."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{shard}")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, of a key; a shard with weight 0 gets nothing."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    draws = [F.struct(draw(key, i, w).alias("draw"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    if not draws:
        raise ValueError("no shard has a weight above 0")
    return F.array_min(F.array(*draws))["shard"]


def part_of(key: Column, parts: int = PARTS) -> Column:
    key = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(parts))


def sharded(
    df: DataFrame, key: str, weights: Sequence[float], more: Sequence[float] | None = None, parts: int = PARTS,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """``df`` with shard, slot and, if weights for ``more`` shards are given, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps, by part, key and ``ties``. Rows that are equal in all of
    these get neighbouring slots. Null keys count as the empty key and so share a shard. Columns of ``df`` with the
    names of the results are replaced.
    """
    df = df.drop("shard", "slot", "grown_shard")
    part, shift = free_name(df, "_part"), free_name(df, "_shift")
    rows = df.withColumn("shard", shard_of(df[key], weights)).withColumn(part, part_of(df[key], parts))
    if more is not None:
        rows = rows.withColumn("grown_shard", shard_of(df[key], [*weights, *more]))
    # At most one row per shard and part, however many records there are.
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy("shard", part).count().select(
        "shard", part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(shift)
    )
    place = F.row_number().over(Window.partitionBy("shard", part).orderBy(F.col(key), *ties))
    return (
        rows.withColumn("slot", place)
        .join(shifts, ["shard", part])
        .withColumn("slot", F.col("slot") + F.col(shift) - 1)
        .drop(part, shift)
    )


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(16)


def report(docs: DataFrame, weights: Sequence[float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its shard and slot, its shard with one more of weight 1, size and checksum of its text.

    A null text has no bytes, so size 16 and checksum 0.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        size_of(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = sharded(rows, "doc_id", weights, [1.0], ties=[F.col("text_crc32"), F.col("size")])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint"), "grown_shard")
