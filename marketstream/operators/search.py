"""Catalogue search by substring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.functions import text

TEXT_COLUMNS = ("name", "description", "category", "brand")


def search(products: DataFrame, query: str | list[str]) -> DataFrame:
    """Products with the query, in any letter case, inside one text field or one tag. Words are joined by blanks;
    an empty query finds all. A narrow scan: no shuffle, no order of its own."""
    needle = query if isinstance(query, str) else " ".join(query)
    hit = F.lit(False)
    for column in TEXT_COLUMNS:
        hit = hit | text.contains_ci(F.col(column), needle)
    return products.filter(hit | text.any_contains_ci(F.col("tags"), needle))


def found(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("found"))


def listing(hits: DataFrame) -> DataFrame:
    """The lines a client shows for each hit."""
    return hits.select(
        "id",
        F.format_string("[%s] %s", "id", "name").alias("title"),
        F.format_string(
            "Category: %s | Brand: %s | Price: %s",
            F.coalesce("category", F.lit("")), "brand", text.price_text(F.col("price"), F.col("currency")),
        ).alias("details"),
        "description",
    )


def padded_name(name_width: int = 40):
    """The product name cut or filled to a fixed width, as publish logs print it (longer names stay whole)."""
    name = F.col("name")
    return F.when(F.length(name) >= name_width, name).otherwise(F.rpad(name, name_width, " "))
