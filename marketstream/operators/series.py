"""Metric series: values at evaluation times, rates, sums by label, last values.

Samples are ``ts, metric, labels, value``. Evaluation times (ticks) are whole multiples of the step since the epoch.
Times are kept as microseconds while they are computed with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.functions import times
from marketstream.operators import membership
from marketstream.session import materialise

MICROS = 1_000_000
DAY = 86_400 * MICROS


def as_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def round_up(at: Column, step: int) -> Column:
    """The first multiple of ``step`` that is not before ``at``, in whole numbers."""
    return at + F.pmod(-at, F.lit(step))


def round_down(at: Column, step: int) -> Column:
    return at - F.pmod(at, F.lit(step))


def order_within(offset: Column, span: int, value: Column) -> Column:
    """A whole number that orders samples by ``offset``, from 0 to ``span``.

    Equal times are settled by a hash of the value, so a task that is run again picks the same sample. One number
    instead of a struct keeps ``max_by`` in a hash aggregate, which needs no sort of the samples.
    """
    bits = min(24, 62 - span.bit_length())
    return F.shiftleft(offset, bits) + F.xxhash64(value).bitwiseAND(F.lit((1 << bits) - 1))


def keyed(samples: DataFrame) -> DataFrame:
    """Samples with a groupable ``series`` and the time ``at`` in microseconds."""
    return samples.select(
        "metric", lb.series_key(F.col("labels")).alias("series"), F.unix_micros("ts").alias("at"), "value")


def _last_in_ticks(samples: DataFrame, step_us: int) -> DataFrame:
    """The last sample of each series up to each tick, after the tick before: ``metric, series, tick, at, value``."""
    return (
        keyed(samples)
        .withColumn("tick", round_up(F.col("at"), step_us))
        .groupBy("metric", "series", "tick")
        .agg(
            F.max("at").alias("at"),
            F.max_by("value", order_within(F.col("at") - F.col("tick") + step_us, step_us, F.col("value"))).alias("value"),
        )
    )


def last_in_ticks(samples: DataFrame, step: str | int = 30) -> DataFrame:
    """The samples that ``at_ticks`` may use, as samples: at most one of a series and tick.

    Cutting parts of a table, and their union again, leaves the samples that cutting the table leaves.
    """
    return _last_in_ticks(samples, times.seconds(step) * MICROS).select(
        F.timestamp_micros("at").alias("ts"), "metric", lb.from_series_key(F.col("series")).alias("labels"), "value")


def at_ticks(
    samples: DataFrame, step: str | int = 30, max_age: str | int = 300, end: int | None = None
) -> DataFrame:
    """Every series' latest value at or before each tick, no older than ``max_age``: ``metric, labels, ts, value``.

    Samples are first cut to the last one of each (series, tick), which a partial aggregate does before the
    shuffle; whatever a series' sample rate, at most one row per tick is left. Each such row then stands for its
    own tick and the following ones up to the next row, its age limit or ``end`` (epoch seconds).
    """
    step_us, age_us = times.seconds(step) * MICROS, times.seconds(max_age) * MICROS
    key = ["metric", "series"]
    latest = _last_in_ticks(samples, step_us)
    following = F.lead("tick").over(W.partitionBy(*key).orderBy("tick"))
    bounds = [round_down(F.col("at") + age_us, step_us), following - step_us]
    if end is not None:
        bounds.append(F.lit(end * MICROS))
    return (
        latest.withColumn("_last", F.least(*bounds))
        .filter(F.col("_last") >= F.col("tick"))
        .select(*key, "value", F.explode(F.sequence("tick", "_last", F.lit(step_us))).alias("tick"))
        .select("metric", lb.from_series_key(F.col("series")).alias("labels"),
                F.timestamp_micros("tick").alias("ts"), "value")
    )


def sum_by(instant: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum at each time by the named labels; the other labels and the metric's name go. No input, no row."""
    label_columns = [lb.label(F.col("labels"), name).alias(f"_{name}") for name in by]
    sums = instant.groupBy("ts", *label_columns).agg(F.sum("value").alias("value"))
    return sums.select("ts", lb.label_map({name: F.col(f"_{name}") for name in by}).alias("labels"), "value")


def matching(samples: DataFrame, metric: str, matchers: dict[str, str] | None = None) -> DataFrame:
    return samples.filter((F.col("metric") == metric) & lb.matches(F.col("labels"), matchers or {}))


def newest(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest ``ts`` and ``value`` that is not null of each key.

    Per day first, where a plain number can order the samples, then over the few days left.
    """
    at = F.unix_micros("ts")
    per_day = (
        samples.filter(F.col("value").isNotNull())
        .groupBy(*keys, F.floor(at / F.lit(DAY)).alias("_day"))
        .agg(F.max("ts").alias("ts"), F.max_by("value", order_within(F.pmod(at, F.lit(DAY)), DAY, F.col("value"))).alias("value"))
    )
    return per_day.groupBy(*keys).agg(F.max(F.struct("ts", "value")).alias("_s")).select(*keys, "_s.ts", "_s.value")


def last_values(samples: DataFrame) -> DataFrame:
    """Each series' newest value that is not null."""
    with_key = samples.select("ts", "metric", "value", lb.series_key(F.col("labels")).alias("series"))
    return newest(with_key, ["metric", "series"]).select(
        "metric", lb.from_series_key(F.col("series")).alias("labels"), "ts", "value")


#: Samples of one series that are ordered together lie in a bucket of time: an eighth of the span, but at least this long.
LEAST_BUCKET = "5 minutes"
BUCKETS_A_SPAN = 8
LOOKUP, SAMPLE = 0, 1


def bucket_width(span: str | int, bucket: str | int | None) -> int:
    """Microseconds of a bucket. A span takes few buckets, and a series that owns many samples still has many."""
    if bucket is not None:
        return times.seconds(bucket) * MICROS
    return max(times.seconds(LEAST_BUCKET), times.seconds(span) // BUCKETS_A_SPAN) * MICROS


def _climb(value: Column, before: Column) -> Column:
    """The increase since the value before; a fall is a counter reset, and the new value is the increase since."""
    return F.when(value >= before, value - before).when(before.isNotNull(), value).otherwise(F.lit(0.0))


def _identified(samples: DataFrame) -> DataFrame:
    """Samples with a time and a value, ``id, metric, series, at, value``; the id is a hash of metric and labels."""
    complete = keyed(samples).filter(F.col("value").isNotNull() & F.col("at").isNotNull())
    return complete.withColumn("id", F.xxhash64("metric", "series"))


def _named(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """``rows`` with the ``metric`` and ``labels`` of their ``id``, which travel once per series and not with each row.

    The names are written down and measured: few are broadcast, many are joined.
    """
    names = samples.select("id", "metric", "series").distinct()
    names = materialise(names.select("id", "metric", lb.from_series_key(F.col("series")).alias("labels")), "names")
    sizes = names.select("id", F.to_json("labels").alias("labels"))
    return rows.join(F.broadcast(names) if membership.is_small(sizes) else names, "id")


def _in_buckets(samples: DataFrame, width: int, span: int | None = None) -> DataFrame:
    """Identified samples by bucket (``id, bucket, pos, kind, value``) with ``inside``, the increases of their bucket so far.

    Of samples at the same time the largest counts. With a ``span`` each sample also places a lookup one span earlier, in
    front of a sample at that time. Rows are shuffled once here, without their labels.
    """
    places = [F.struct(F.col("at").alias("pos"), F.lit(SAMPLE).alias("kind"), "value")]
    if span is not None:
        places.append(F.struct((F.col("at") - span).alias("pos"), F.lit(LOOKUP).alias("kind"), F.lit(None).cast("double").alias("value")))
    placed = samples.select("id", F.inline(F.array(*places)))
    # The filter keeps every row. Joins need it, and one that stands here in all copies of the plan lets them share the shuffle.
    dealt = placed.withColumn("bucket", round_down(F.col("pos"), width)).filter(F.col("bucket").isNotNull()).repartition("id", "bucket")
    ordered = W.partitionBy("id", "bucket").orderBy("pos", "kind", "value")
    again = (F.lead("pos").over(ordered) == F.col("pos")) & (F.lead("kind").over(ordered) == F.col("kind"))
    once = dealt.withColumn("_again", F.coalesce(again, F.lit(False))).filter(~F.col("_again")).drop("_again")
    before = F.last("value", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    inc = F.when(F.col("kind") == SAMPLE, _climb(F.col("value"), before))
    return once.withColumn("_inc", inc).withColumn("inside", F.sum("_inc").over(ordered.rowsBetween(W.unboundedPreceding, 0))).drop("_inc")


def _summaries(rows: DataFrame) -> DataFrame:
    """One row per bucket: what a bucket of a counter has to know of the others.

    A bucket is summed up by its first and last sample and the increase between them. Summaries add up from left to right: the step from one
    bucket's last to the next one's first sample joins them. ``base`` is the sum of all increases up to the bucket's
    first sample, ``before`` the time of the last sample of earlier buckets, ``after`` time and sum of the first sample of later ones.
    """
    at = F.when(F.col("kind") == SAMPLE, F.col("pos"))
    ends = rows.groupBy("id", "bucket").agg(
        F.min(at).alias("_at"), F.max(at).alias("_until"), F.min_by("value", at).alias("_first"), F.max_by("value", at).alias("_last"),
        F.max("inside").alias("_inside"),
    )
    buckets = W.partitionBy("id").orderBy("bucket")
    earlier, later = (w.rowsBetween(W.unboundedPreceding, -1) for w in (buckets, W.partitionBy("id").orderBy(F.desc("bucket"))))
    entry = F.when(F.col("_first").isNotNull(), _climb(F.col("_first"), F.last("_last", ignorenulls=True).over(earlier)))
    ends = ends.withColumn("_entry", entry)
    ends = ends.withColumn("base", F.coalesce(F.sum(F.col("_entry") + F.col("_inside")).over(earlier), F.lit(0.0)) + F.col("_entry"))
    first = F.when(F.col("_at").isNotNull(), F.struct(F.col("_at").alias("at"), F.col("base").alias("sum")))
    return ends.select(
        "id", "bucket", "base", F.last("_until", ignorenulls=True).over(earlier).alias("before"),
        F.last(first, ignorenulls=True).over(later).alias("after"),
    )


def rate(samples: DataFrame, span: str | int = 60, bucket: str | int | None = None) -> DataFrame:
    """Per-second increase at each sample over the ``span`` before it, ends included; null for a lone sample.

    There is no extrapolation to the span's edges. The rate is the difference of two looked-up sums of increases: that at the
    sample, and that at the first sample from one span earlier on. Both are found among the rows of one bucket, or in
    the summary of the buckets, and meet by series and time.
    """
    span_us = times.seconds(span) * MICROS
    width = bucket_width(span, bucket)
    samples = _identified(samples)
    rows = _in_buckets(samples, width, span_us)
    falling = W.partitionBy("id", "bucket").orderBy(F.desc("pos"), F.desc("kind")).rowsBetween(W.unboundedPreceding, 0)
    here = F.when(F.col("kind") == SAMPLE, F.struct(F.col("pos").alias("at"), F.col("inside").alias("sum")))
    found = rows.withColumn("_next", F.last(here, ignorenulls=True).over(falling)).join(_summaries(rows), ["id", "bucket"])
    is_lookup = F.col("kind") == LOOKUP
    start_at = F.when(is_lookup, F.coalesce("_next.at", "after.at"))
    start_sum = F.when(is_lookup, F.coalesce(F.col("base") + F.col("_next.sum"), F.col("after.sum")))
    met = found.select(
        "id", F.when(is_lookup, F.col("pos") + span_us).otherwise(F.col("pos")).alias("at"),
        "value",
        F.when(~is_lookup, F.col("base") + F.col("inside")).alias("_sum"), start_at.alias("_start"), start_sum.alias("_from"),
    ).groupBy("id", "at").agg(*[F.max(c).alias(c) for c in ("value", "_sum", "_start", "_from")])
    elapsed = (F.col("at") - F.col("_start")) / F.lit(MICROS)
    rated = met.select("id", F.timestamp_micros("at").alias("ts"), "value", F.try_divide(F.col("_sum") - F.col("_from"), elapsed).alias("rate"))
    return _named(rated, samples).select("metric", "labels", "ts", "value", "rate")


def rate_at_ticks(
    samples: DataFrame, span: str | int = 60, step: str | int = 30, bucket: str | int | None = None, end: int | None = None
) -> DataFrame:
    """The rate over the ``span`` before each tick: ``metric, labels, ts, value``. A span with one sample has none.

    A span's rate is the difference of the sums of increases at its last and its first sample. A sample is the last one of
    the ticks up to the next sample, and the first one of those whose span begins after the sample before; it is sent to these alone, so
    a tick of a series gets two rows, however many samples its span holds.
    """
    span_us, step_us = times.seconds(span) * MICROS, times.seconds(step) * MICROS
    samples = _identified(samples)
    rows, at = _in_buckets(samples, bucket_width(span, bucket)), F.col("pos")
    local = W.partitionBy("id", "bucket").orderBy("pos", "kind", "value")
    neighbours = rows.withColumns({"_prior": F.lag("pos").over(local), "_next": F.lead("pos").over(local)})
    found = neighbours.join(_summaries(rows), ["id", "bucket"])
    prior, following = F.coalesce("_prior", "before"), F.coalesce("_next", "after.at")
    begin, until = round_up(at, step_us), round_down(at + span_us, step_us)
    if end is not None:
        until = F.least(until, F.lit(end * MICROS))
    ranges = F.array(
        F.struct(begin.alias("first"), F.least(until, round_down(following - 1, step_us)).alias("last"), F.lit(True).alias("is_last")),
        F.struct(F.greatest(begin, round_up(prior + span_us + 1, step_us)).alias("first"), until.alias("last"), F.lit(False).alias("is_last")),
    )
    sent = (
        found.select("id", at.alias("at"), (F.col("base") + F.col("inside")).alias("sum"), F.inline(ranges))
        .filter(F.col("first") <= F.col("last"))
        .withColumn("tick", F.explode(F.sequence("first", "last", F.lit(step_us))))
    )
    ends = {f"_{name}_{c}": F.max(F.when(F.col("is_last") == is_last, F.col(c))) for name, is_last in (("last", True), ("first", False)) for c in ("at", "sum")}
    met = sent.groupBy("id", "tick").agg(*[c.alias(n) for n, c in ends.items()]).filter("_last_at > _first_at")
    elapsed = (F.col("_last_at") - F.col("_first_at")) / F.lit(MICROS)
    value = (F.col("_last_sum") - F.col("_first_sum")) / elapsed
    rated = met.select("id", F.timestamp_micros("tick").alias("ts"), value.alias("value"))
    return _named(rated, samples).select("metric", "labels", "ts", "value")
