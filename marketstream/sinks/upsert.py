"""A result table that holds the newest row of each key, over a log of batches.

A stream in update mode writes a new version of a row with every batch that changes it. The log keeps all versions. Beside it
stands a base: the newest row of each key up to some batch. A reader takes the base and the few batches after it, so what it reads is bounded
by the number of keys and ``every`` batches, not by the stream's age.

Which base and which batches belong together is said by a pointer, one row that a batch writes last. A reader goes by the newest pointer and
sees a whole batch or nothing of it. Folders that the newest two pointers do not name are removed, so a reader that has just read
a pointer finds its folders. A batch that runs again writes the same base and pointer again.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream.session import delete_folder
from marketstream.sinks.files import batch_folder, write_batch

BASE, POINTER = "base", "pointer"
POINTER_ROW = "base bigint, deltas array<bigint>, batch_id bigint"
#: Batches between two bases.
EVERY = 10


def newest(rows: DataFrame, keys: Sequence[str], order: str = "batch_id") -> DataFrame:
    """The row of each key with the largest ``order``; null keys are keys too. Versions are cut down before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])


def _pointers(spark: SparkSession, table: str) -> list:
    """The pointers that are left, newest first; the writer keeps two."""
    try:
        return spark.read.schema(POINTER_ROW).parquet(f"{table}/{POINTER}").orderBy(F.desc("batch_id")).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _merged(spark: SparkSession, log: str, table: str, schema: T.StructType, keys: Sequence[str], base: int | None, deltas: Sequence[int]) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    parts = [spark.read.schema(schema).parquet(batch_folder(log, d)).withColumn("version", F.lit(d).cast("bigint")) for d in deltas]
    if base is not None:
        parts.append(spark.read.schema(full).parquet(batch_folder(f"{table}/{BASE}", base)))
    if not parts:
        return spark.createDataFrame([], full)
    return newest(functools.reduce(DataFrame.unionByName, parts), keys, "version")


def commit(
    spark: SparkSession, log: str, table: str, batch_id: int, schema: T.StructType, keys: Sequence[str], every: int | None = None,
) -> None:
    """Make batch ``batch_id``, which the log has whole, part of the table. Batches without a change need no commit."""
    older = [p for p in _pointers(spark, table) if p["batch_id"] < batch_id]
    base, deltas = (older[0]["base"], list(older[0]["deltas"])) if older else (None, [])
    deltas.append(batch_id)
    if len(deltas) >= (every or EVERY):
        merged = _merged(spark, log, table, schema, keys, base, deltas)
        write_batch(merged, f"{table}/{BASE}", batch_id)
        base, deltas = batch_id, []
    pointer = spark.createDataFrame([(base, deltas)], "base bigint, deltas array<bigint>")
    write_batch(pointer.coalesce(1), f"{table}/{POINTER}", batch_id)
    for p in older[1:]:
        delete_folder(spark, batch_folder(f"{table}/{POINTER}", p["batch_id"]))
        if p["base"] is not None and p["base"] not in (base, older[0]["base"]):
            delete_folder(spark, batch_folder(f"{table}/{BASE}", p["base"]))


def current(spark: SparkSession, log: str, table: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, with the ``version``: the batch that wrote it. An unwritten table is empty."""
    pointers = _pointers(spark, table)
    base, deltas = (pointers[0]["base"], pointers[0]["deltas"]) if pointers else (None, [])
    return _merged(spark, log, table, schema, keys, base, deltas)
