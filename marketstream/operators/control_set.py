"""The set of banned categories as a one-column table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.functions import text
from marketstream.operators import membership


def _names(like: DataFrame, categories: DataFrame | Iterable[str]) -> DataFrame:
    """Normalised names; a blank one is an error."""
    if not isinstance(categories, DataFrame):
        categories = like.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    name = text.normalise_category(F.col("category"))
    blank = F.coalesce(name, F.lit("")) == ""
    checked = F.when(blank, F.raise_error(F.lit("a category name must not be blank"))).otherwise(name)
    return categories.select(checked.cast("string").alias("category"))


def add(banned: DataFrame, categories: DataFrame | Iterable[str]) -> DataFrame:
    """Names are trimmed and lower-cased first; one already listed changes nothing."""
    return banned.select("category").union(_names(banned, categories)).distinct()


def remove(banned: DataFrame, categories: DataFrame | Iterable[str]) -> DataFrame:
    """The same normalising; an unknown name changes nothing."""
    gone = _names(banned, categories).distinct()
    return membership.join_set(banned.select("category").distinct(), gone, "category", "left_anti")


def listing(banned: DataFrame) -> DataFrame:
    return banned.select("category").distinct().orderBy("category")
