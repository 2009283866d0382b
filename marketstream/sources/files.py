"""Catalogue, control set, JSON lines and message tables kept as files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream import schemas
from marketstream.session import is_directory
from marketstream.sources import json_array

# The control set used when no file exists.
DEFAULT_BANNED = ["tobacco", "alcohol", "weapons"]


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The products of JSON arrays, read by as many tasks as the files have ranges; a broken file is an error."""
    return json_array.read(spark, path, schemas.PRODUCT).select("element.*")


def control_set(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of category names without duplicates; the default set when the file is missing."""
    try:
        names = json_array.read(spark, path, T.StringType(), ",")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([(c,) for c in DEFAULT_BANNED], "category string")
    return names.select(F.col("element").alias("category")).filter(F.col("category").isNotNull()).distinct()


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def text_messages(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of text as message values without a key, for files that stand in for a topic."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files or a single file."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).options(**options)
    if is_directory(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)
