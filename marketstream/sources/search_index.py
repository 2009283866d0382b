"""A catalogue kept in parts, with a signature of each part that tells which texts it cannot hold.

The signature of a part is a bitmap of the hashes of all runs of three letters in the texts and tags of its products. A product
can only contain a query if its part has all runs of three of the query. Parts that lack one are not read: the
scan is partitioned by part and joined with the parts that remain, which prunes its partitions. What is read is searched as
ever, so hashes that fall together cost reading and never a wrong row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream import schemas
from marketstream.operators import search

PRODUCTS, SIGNATURES = "products", "signatures"
SIGNATURE = "part int, bucket bigint, bits binary"
#: Bits of a signature, 32 kB a part where all are used, and the bits of one row of the built-in bitmaps.
BITS, ROW_BITS = 1 << 18, 1 << 15
#: The largest number of parts; so many small rows may be broadcast.
MOST_PARTS = 1 << 14


def runs(text: Column) -> Column:
    """Every run of three characters of a text in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?=(...))"), F.lit(1))


def place(run: Column) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(BITS))


def all_runs() -> Column:
    texts = [F.coalesce(runs(F.col(c)), F.array().cast("array<string>")) for c in search.TEXT_COLUMNS]
    tags = F.flatten(F.transform(F.filter("tags", lambda t: t.isNotNull()), runs))
    return F.array_distinct(F.concat(*texts, F.coalesce(tags, F.array().cast("array<string>"))))


def with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])


def build(products: DataFrame, path: str, parts: int, by: tuple[str, ...] = ("category", "name")) -> None:
    """Write the catalogue below ``path`` in up to ``parts`` parts of neighbours by ``by``, and the signatures of the parts."""
    if not 0 < parts <= MOST_PARTS:
        raise ValueError(f"the number of parts must be from 1 to {MOST_PARTS}")
    spark = products.sparkSession
    dealt = products.repartitionByRange(parts, *by).withColumn("part", F.spark_partition_id())
    dealt.write.partitionBy("part").parquet(f"{path}/{PRODUCTS}")
    stored = spark.read.schema(with_part(products.schema)).parquet(f"{path}/{PRODUCTS}")
    at = stored.select("part", F.explode(all_runs()).alias("run")).select("part", place(F.col("run")).alias("at"))
    bits = at.groupBy("part", F.floor(F.col("at") / ROW_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(ROW_BITS))).alias("bits"))
    bits.write.parquet(f"{path}/{SIGNATURES}")


def products(spark: SparkSession, path: str) -> DataFrame:
    """The whole catalogue, with the ``part`` of each product."""
    return spark.read.schema(with_part(schemas.PRODUCT)).parquet(f"{path}/{PRODUCTS}")


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame | None:
    """The parts whose signatures have every run of the query, one row a part; none for a query too short to have a run."""
    wanted = spark.range(1).select(F.explode(F.array_distinct(runs(F.lit(query)))).alias("run")).select(place(F.col("run")).alias("at")).distinct()
    wanted = wanted.select(F.floor(F.col("at") / ROW_BITS).alias("bucket"), F.pmod("at", F.lit(ROW_BITS)).cast("int").alias("bit"))
    # One row for each run of the query.
    n = wanted.count()
    if not n:
        return None
    signatures = spark.read.schema(SIGNATURE).parquet(f"{path}/{SIGNATURES}")
    met = signatures.join(F.broadcast(wanted), "bucket")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    has = F.call_function("shiftright", byte, F.col("bit") % 8).bitwiseAND(F.lit(1)) == 1
    return met.filter(has).groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") == n).select("part")


def find(spark: SparkSession, path: str, query: str | list[str]) -> DataFrame:
    """``search.search`` over the parts that can hold the query; one of less than three letters is looked for in all."""
    needle = query if isinstance(query, str) else " ".join(query)
    rows, parts = products(spark, path), candidates(spark, path, needle)
    if parts is not None:
        rows = rows.join(F.broadcast(parts), "part", "left_semi")
    return search.search(rows, needle).drop("part")
