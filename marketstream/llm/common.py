"""Shared pieces of the text operators: tables, written intermediate results, numbering, free column names."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketstream.session import delete_folder, scratch_dir

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and continue from the files.

    Later steps then neither repeat the work nor depend on the executors that did it. The shuffle files of
    the finished write are given back at once, so a chain of steps needs the disk of its largest one.
    """
    spark = df.sparkSession
    path, before = scratch_dir(spark, name), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Remove the files of a ``written`` result that nothing reads any more."""
    for folder in {unquote(f).rpartition("/")[0] for f in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: the position of each row, from 0, in the given order.

    Ranges of the order are sorted side by side and moved up by the rows before them; only one count
    per range meets in one task.
    """
    part = free_name(df, "_range")
    ranges = written(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = ranges.groupBy(part).count().select(
        part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return (
        ranges.withColumn(name, place)
        .join(shift, part)
        .withColumn(name, F.col(name) + F.col("_shift") - 1)
        .drop(part, "_shift")
    )


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null is empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
