"""Record types carried by the streams and tables (fixed values: field names and types)."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("created_at", T.StringType()),
])

CLIENT_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# What the counting job needs of an event; parsing three fields instead of six is cheaper.
PRODUCT_ACTIVITY = T.StructType(
    [f for f in CLIENT_EVENT.fields if f.name in ("user_id", "product_id", "timestamp")]
)

RECOMMENDATION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("product_ids", T.ArrayType(T.StringType())),
    T.StructField("generated_at", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
