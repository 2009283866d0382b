"""JSON records in message values: decode with dead letters, encode with keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream import schemas

_CORRUPT = "_corrupt"


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column by way of ``explode`` of a one-element array.

    The optimizer moves no filter across it. A filter on an ordinary column is pushed below the projection that
    makes it, and the expression (a JSON or time parse) is then evaluated again for the filter.
    """
    return df.withColumn(name, F.explode(F.array(column)))


def as_text(value: Column) -> Column:
    return value.cast("string")


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``data`` (the record, null when unreadable) and ``dead`` (unreadable or a field of the wrong type).

    A record that lacks fields is readable; its fields are null.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(as_text(F.col(value)), with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    dead = F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    record = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    return (
        computed_once(df, "_parsed", parsed)
        .withColumn("dead", dead)
        .withColumn("data", F.when(~dead, record))
        .drop("_parsed")
    )


def decode(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Readable records only, one column per field, after the ``keep`` columns."""
    return parse_json(df, schema, value).filter(~F.col("dead")).select(*keep, "data.*")


def dead_letters(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """The rows ``decode`` leaves out, with the raw text and the reason."""
    text = as_text(F.col(value))
    return (
        parse_json(df, schema, value)
        .filter("dead")
        .select(
            *keep,
            text.alias("raw"),
            F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("empty")).otherwise(F.lit("malformed")).alias("reason"),
        )
    )


def zero_values(df: DataFrame) -> DataFrame:
    """Absent product fields as the empty values they have on the wire."""
    empty = {"string": F.lit(""), "double": F.lit(0.0), "bigint": F.lit(0)}
    names = set(df.columns)
    return df.withColumns({
        f.name: F.coalesce(F.col(f.name), empty[f.dataType.simpleString()])
        for f in schemas.PRODUCT.fields
        if f.name in names and f.dataType.simpleString() in empty
    })


def encode(df: DataFrame, schema: T.StructType, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key`` and the JSON ``value`` of the schema's fields."""
    return df.select(
        *keep,
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("value"),
    )
