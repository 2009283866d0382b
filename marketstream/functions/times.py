"""Timestamps as text and durations as seconds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_UNIT_SECONDS = {"s": 1, "second": 1, "m": 60, "minute": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400}


def seconds(duration: str | int) -> int:
    """``"5 minutes"``, ``"30s"`` or a plain number of seconds, as whole seconds."""
    if isinstance(duration, int):
        return duration
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", duration.lower())
    unit = match and ("s" if match[2] == "" else match[2])
    if not match or unit not in _UNIT_SECONDS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match[1]) * _UNIT_SECONDS[unit]


def parse_rfc3339(text: Column) -> Column:
    """Null, not an error, for text that is no timestamp."""
    return F.try_to_timestamp(text)


def format_rfc3339(ts: Column) -> Column:
    """Second precision; the literal ``Z`` holds because the session runs in UTC."""
    return F.date_format(ts, RFC3339_SECONDS)


def unix_nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000)
