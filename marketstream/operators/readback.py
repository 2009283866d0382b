"""What a reader does with recommendation messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.functions import codec


def read(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decoded recommendations; an unreadable message keeps its text in ``raw`` instead of failing."""
    parsed = codec.parse_json(messages, schemas.RECOMMENDATION)
    return parsed.select(
        *keep,
        F.col("data.user_id").alias("user_id"),
        F.col("data.product_ids").alias("product_ids"),
        F.col("data.generated_at").alias("generated_at"),
        F.when(F.col("dead"), codec.as_text(F.col("value"))).alias("raw"),
    )


def numbered(recommendations: DataFrame) -> DataFrame:
    """One row per recommended product, counted from 1; messages without a list give none."""
    others = [c for c in recommendations.columns if c not in ("product_ids", "raw")]
    return recommendations.select(*others, F.posexplode("product_ids").alias("_pos", "product_id")).select(
        *others, (F.col("_pos") + 1).alias("position"), "product_id"
    )
