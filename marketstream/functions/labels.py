"""Label maps of metric series and alerts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(labels: Column, name: str) -> Column:
    """A label's value; an absent label equals the empty text."""
    return F.coalesce(labels[name], F.lit(""))


def matches(labels: Column, matchers: Mapping[str, str]) -> Column:
    """All equality matchers hold."""
    result = F.lit(True)
    for name, value in matchers.items():
        result = result & (label(labels, name) == F.lit(value))
    return result


def label_map(pairs: Mapping[str, Column]) -> Column:
    """A label map; null and empty values leave their label out."""
    if not pairs:
        return F.create_map().cast("map<string,string>")
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs.items()])
    return F.map_from_entries(F.filter(entries, lambda e: F.coalesce(e["value"], F.lit("")) != ""))


def add_label(labels: Column, name: str, value: Column) -> Column:
    """Set a label, replacing an older value; an empty value removes the label."""
    rest = F.map_filter(labels, lambda k, _: k != F.lit(name))
    return F.map_concat(rest, label_map({name: value}))


def series_key(labels: Column) -> Column:
    """Labels as a sorted array: equal for equal label sets, and usable as a grouping key."""
    return F.sort_array(F.map_entries(labels))


def from_series_key(key: Column) -> Column:
    return F.map_from_entries(key)


def label_text(labels: Column) -> Column:
    """``a=1,b=2`` in label order, for listings."""
    return F.array_join(F.transform(series_key(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def keep_labels(labels: Column, names: Iterable[str]) -> Column:
    return F.map_filter(labels, lambda k, v: k.isin(*names) & (v != ""))
