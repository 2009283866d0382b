"""Job settings from the environment; an empty variable counts as unset."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def env(name: str, default: str, environ: Mapping[str, str] | None = None) -> str:
    return (os.environ if environ is None else environ).get(name) or default


def env_int(name: str, default: int, environ: Mapping[str, str] | None = None) -> int:
    """A whole number; anything else is an error that names the variable."""
    text = env(name, str(default), environ)
    try:
        return int(text)
    except ValueError:
        raise ValueError(f"{name} is not a whole number: {text!r}") from None


def or_default(column: Column, default: str) -> Column:
    """The same rule for a column: null and empty text take the default."""
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(default))


@dataclass(frozen=True)
class StreamConfig:
    """Where the recommendation job reads and writes, and how it counts."""

    brokers: str = "kafka-analytics:9092"
    topic_in: str = "cluster1.client-events"
    topic_out: str = "recommendations"
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    ca_path: str | None = None
    window: str = "5 minutes"
    slide: str = "2 minutes"
    lateness: str = "10 minutes"
    trigger: str = "60 seconds"
    top_k: int = 5

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None) -> "StreamConfig":
        """Credentials have no default: without them the job connects in the clear."""
        return cls(
            brokers=env("KAFKA_BROKERS", cls.brokers, environ),
            topic_in=env("TOPIC_IN", cls.topic_in, environ),
            topic_out=env("TOPIC_OUT", cls.topic_out, environ),
            user=env("KAFKA_USER", "", environ) or None,
            password=env("KAFKA_PASSWORD", "", environ) or None,
            ca_path=env("KAFKA_TLS_CA", "", environ) or None,
            top_k=env_int("TOP_K", cls.top_k, environ),
        )


@dataclass(frozen=True)
class ScreeningConfig:
    """Where the screening job reads and writes, and where its banned set lies."""

    brokers: str = "kafka-1:9092"
    topic_in: str = "products-raw"
    topic_out: str = "products-filtered"
    banned_path: str = "banned_categories.json"
    normalise: bool = False
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    ca_path: str | None = None
    trigger: str = "60 seconds"

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None) -> "ScreeningConfig":
        return cls(
            brokers=env("KAFKA_BROKERS", cls.brokers, environ),
            topic_in=env("TOPIC_IN", cls.topic_in, environ),
            topic_out=env("TOPIC_OUT", cls.topic_out, environ),
            banned_path=env("BANNED_FILE", cls.banned_path, environ),
            user=env("KAFKA_USER", "", environ) or None,
            password=env("KAFKA_PASSWORD", "", environ) or None,
            ca_path=env("KAFKA_TLS_CA", "", environ) or None,
        )
