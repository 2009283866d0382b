"""Joins against a set of keys of any size, which move only rows that the set may hold.

A small set is broadcast. For a larger one the keys are put into a Bloom filter of fixed size, built and tested by built-in bit
functions: every key sets a few bits of one 64-bit word. The filter is broadcast in place of the set, and rows that
miss a bit are known not to be in the set and stay where they are.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.session import materialise

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
#: Words of the filter, of 16 bytes each when broadcast: 8 MB, whatever the set. 0.1 % of other keys pass for half a million keys.
WORDS = 1 << 19
#: Bits of its word that a key sets.
BITS = 4
WORD, MASK, FOUND, MAY = "__word", "__mask", "__found", "__may"


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> bool:
    """Measure a table that may be broadcast; reads no more than ``rows + 1`` rows of it."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= rows and total <= bytes_


def word_and_mask(key: Column) -> tuple[Column, Column]:
    """The word of a key, and the bits it sets there, from separate bits of one hash."""
    h, one = F.xxhash64(key), F.lit(1).cast("bigint")
    places = [F.shiftright(h, 20 + 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int") for i in range(BITS)]
    bits = [F.call_function("shiftleft", one, p) for p in places]
    return h.bitwiseAND(F.lit(WORDS - 1).cast("bigint")), functools.reduce(Column.bitwiseOR, bits)


def bloom(keys: DataFrame, on: str) -> DataFrame:
    """The words of the filter that are not zero, at most ``WORDS`` rows."""
    word, mask = word_and_mask(F.col(on))
    return keys.filter(F.col(on).isNotNull()).select(word.alias(WORD), mask.alias(MASK)).groupBy(WORD).agg(F.bit_or(MASK).alias(FOUND))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def marked(df: DataFrame, keys: DataFrame, on: str, may: str = MAY) -> DataFrame:
    """``df`` with the new column ``may``: false where the key is certainly not among ``keys`` or null."""
    word, mask, found = (unused(df, name) for name in (WORD, MASK, FOUND))
    at, bits = word_and_mask(F.col(on))
    words = bloom(keys, on).select(F.col(WORD).alias(word), F.col(FOUND).alias(found))
    tested = df.withColumns({word: at, mask: bits}).join(F.broadcast(words), word, "left")
    passes = F.col(on).isNotNull() & (F.col(found).bitwiseAND(F.col(mask)) == F.col(mask))
    return tested.withColumn(may, F.coalesce(passes, F.lit(False))).drop(word, mask, found)


def join_set(df: DataFrame, keys: DataFrame, on: str, how: str, small: bool | None = None) -> DataFrame:
    """``left_anti``, ``left_semi`` or ``left`` join of ``df`` with the rows of ``keys``, unique by ``on``.

    A small set is broadcast. Of a large one only the keys that ``df`` has matter: those that pass the filter are collected as
    distinct keys, before the shuffle as far as a task has them, so a key that owns a large share of the rows is a few
    rows here. Where few of them are in the set, they are broadcast in its place and ``df`` is not shuffled at all; else
    the rows that pass the filter are shuffled, and adaptive execution splits a large key. A stream, which cannot be looked
    at first, always shuffles the rows that pass. Rows with a null key match nothing.
    """
    if how not in ("left_anti", "left_semi", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if small is None:
        small = is_small(keys)
    if small:
        return df.join(F.broadcast(keys), on, how)
    if not df.isStreaming:
        occurring = marked(df.select(on), keys, on).filter(F.col(MAY)).select(on).distinct()
        keys = materialise(keys.join(occurring, on, "left_semi"), "members")
        if is_small(keys):
            return df.join(F.broadcast(keys), on, how)
    return filtered_join(df, keys, on, how)


def filtered_join(df: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """The join by the filter alone: rows that pass it are shuffled, the others are not. One plan at every size.

    For keys that are known to occur in ``df``, and for streams.
    """
    may = unused(df, MAY)
    tested = marked(df, keys, on, may)
    moved = tested.filter(F.col(may)).drop(may).join(keys, on, how)
    if how == "left_semi":
        return moved
    return tested.filter(~F.col(may)).drop(may).unionByName(moved, allowMissingColumns=how == "left")
