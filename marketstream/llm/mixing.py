"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents. The whole part is taken as it
is; the fractional parts are rounded in pairs. A pair trades words at random, as many as one gains the other loses,
until one of the two is taken or left, so the source's expected words never change and each document's chance is its
fraction. What is left open in a bucket of documents, one document at most, meets the others of its kind in the
next level of a reduction tree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import free_name, numbered, written
from marketstream.llm.words import GOLDEN, mix

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents of a bucket at the lowest level, on average, and buckets that meet in one of the next.
BUCKET = 1_000
FAN_IN = 64
SEED = 1


def words_in(text: Column) -> Column:
    """The number of words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, place and target.

    Sources by code point, null last, weigh as ``weights`` say, over and over, and share the sum of all sizes. No target is above
    ``most`` times its source's size; the excess goes to the others by weight. Such targets are the smaller of that bound and
    level * weight, for the one level at which they add up to the sum.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = numbered(totals, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = written(places.withColumn("weight", weight.cast("bigint")), "sources")
    limit = F.col("source_size") * most
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        # The sources that are full at this level stay so at any higher one.
        full = limit <= F.col("weight") * F.lit(level)
        now, held, open_ = rows.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        if now == n_full or not open_:
            break
        level, n_full = (total - held) / open_, now
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level)))
    return rows.select("source", "source_size", "place", target.alias("target"))


def draws(keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that the keys and their order decide."""
    place = mix((np.arange(len(keys), dtype=np.uint64) + np.uint64(SEED)) * GOLDEN)
    return (mix(keys.astype(np.int64).view(np.uint64) ^ place) >> np.uint64(11)).astype(float) / (1 << 53)


def trade(p: float, a: int, q: float, b: int, u: float) -> tuple[float, float]:
    """Move words between fractions p of size a and q of size b until one of them is 0 or 1.

    p * a + q * b stays, and so do the expectations of p and q.
    """
    room, spare = a * (1 - p), b * q  # words that p can gain, that q can lose
    lose, gain = a * p, b * (1 - q)
    up, down = min(room, spare), min(lose, gain)
    if u * (up + down) < down:
        return 1.0 if room <= spare else p + spare / a, 0.0 if spare <= room else q - room / b
    return 0.0 if lose <= gain else p - gain / a, 1.0 if gain <= lose else q + lose / b


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Round all fractions of a bucket but the one that is left open in the end."""
    rows = rows.sort_values(["key", "size", "fraction"], kind="stable", ignore_index=True)
    fractions, sizes, keys = rows["fraction"].to_numpy().copy(), rows["size"].to_numpy(), rows["key"].to_numpy()
    left, chance = -1, draws(keys)
    for i in np.flatnonzero((fractions > 0) & (fractions < 1)):
        if left >= 0:
            p, q = trade(fractions[left], int(sizes[left]), fractions[i], int(sizes[i]), chance[i])
            fractions[left], fractions[i] = p, q
        if 0 < fractions[i] < 1:
            left = i
        elif left >= 0 and not 0 < fractions[left] < 1:
            left = -1
    return rows.assign(fraction=fractions)


def rounded(rows: DataFrame, bucket: int = BUCKET, fan_in: int = FAN_IN) -> DataFrame:
    """``rows`` (group, key, size, fraction and others) with every fraction 0 or 1.

    Per group, the sum of size * fraction changes by less than the largest size. The result depends on the rows alone, not on
    how they are stored. Rows of size 0 change no sum and are rounded one by one.
    """
    n = 1 + rows.count() // bucket
    alone = F.xxhash64(F.lit(SEED), "key").cast("double") / F.lit(2.0**64) + 0.5
    fraction = F.when(F.col("size") > 0, F.col("fraction")).otherwise((alone < F.col("fraction")).cast("double"))
    left = rows.withColumn("fraction", fraction).withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(n)))
    is_open = (F.col("fraction") > 0) & (F.col("fraction") < 1)
    done = []
    while True:
        level = written(left.groupBy("group", "_bucket").applyInPandas(settle, left.schema), "rounding")
        done.append(level.filter(~is_open))
        left = level.filter(is_open)
        if n == 1:
            break
        n = -(-n // fan_in)
        left = left.withColumn("_bucket", F.pmod("_bucket", F.lit(n)))
    # One row per group at most is open now.
    done.append(left.withColumn("fraction", (alone < F.col("fraction")).cast("double")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("_bucket")


def mixture(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, bucket: int = BUCKET, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, source, size, source_size, target, copies and taken.

    ``copies`` is how often the mix takes the document, ``taken`` the words this makes. A null text has size 0; documents of
    size 0 are taken with their chance, but add nothing. A source without words has target 0 and is left out. Repeated
    rows are rounded one by one. Null sources form a source of their own; null ids are fine.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(source).cast("string").alias("source"),
        words_in(F.col(text)).alias("size"),
    )
    rows = written(rows, "sizes")
    targets = source_targets(rows, weights, most)
    # One row per source: joined by shuffle or broadcast, as its size turns out.
    joined = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    parts = joined.withColumn("base", F.floor(ratio)).withColumn("fraction", ratio - F.floor(ratio))
    parts = parts.withColumn("group", F.col("place")).withColumn("key", F.xxhash64("doc_id", "text_hash"))
    copies = F.col("base") + F.col("fraction").cast("bigint")
    return (
        rounded(parts.drop("place"), bucket, fan_in)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("base", "fraction", "group", "key")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; the columns stay as they are.

    Which of several rows with the same id and text gets which number of copies follows no order.
    """
    taken = mixture(docs, doc_id, text, source, **options)
    lists = taken.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("copies")).alias("_copies"))
    nth, hashed, names = free_name(docs, "_nth"), free_name(docs, "_text_hash"), ["_id", "_hash", "_copies"]
    decided = lists.toDF(*(free_name(docs, n) for n in names))
    i, h, c = decided.columns
    keyed = docs.withColumn(hashed, F.xxhash64(text))
    # There is a decision for nearly every document, so they are never broadcast, however few there happen to be.
    both = keyed.join(decided.hint("merge"), F.col(doc_id).eqNullSafe(F.col(i)) & (F.col(hashed) == F.col(h)))
    several = F.size(c) > 1
    order = Window.partitionBy(doc_id, hashed).orderBy(hashed)
    one = both.filter(~several).withColumn(nth, F.lit(1))
    more = both.filter(several).withColumn(nth, F.row_number().over(order))
    times = F.element_at(c, F.col(nth)).cast("int")
    return one.unionByName(more).withColumn(nth, F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)
