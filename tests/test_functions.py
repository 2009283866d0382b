import pytest
from pyspark.sql import functions as F

from marketstream import config
from marketstream.functions import codec, labels, text, times
from marketstream.operators import events
from marketstream import schemas


def one(spark, column, **values):
    """Evaluate an expression over one row of named values."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


@pytest.mark.parametrize("value, expected", [
    (0.0, "0"), (1500.0, "1500"), (-2.5, "-2.5"), (0.25, "0.25"), (999999.0, "999999"), (1e6, "1e+06"),
    (1234567.5, "1.2345675e+06"), (-1234567.5, "-1.2345675e+06"), (1e7, "1e+07"), (12345678.0, "1.2345678e+07"),
    (1.5e300, "1.5e+300"), (0.0001, "0.0001"), (0.00012, "0.00012"), (0.00001, "1e-05"),
    (float("nan"), "NaN"), (float("inf"), "+Inf"), (float("-inf"), "-Inf"),
])
def test_plain_number(spark, value, expected):
    assert one(spark, text.plain_number(F.col("v")), v=value) == expected


@pytest.mark.parametrize("value, expected", [
    (0.0, "0"), (1.0, "1"), (999.0, "999"), (1500.0, "1.5k"), (12345.0, "12.35k"), (10737418240.0, "10.74G"),
    (2.5e24, "2.5Y"), (0.25, "250m"), (0.000015, "15u"), (-1500.0, "-1.5k"), (35855000000.0, "35.85G"),
])
def test_humanise(spark, value, expected):
    assert one(spark, text.humanise(F.col("v")), v=value) == expected


def test_template(spark):
    template = "{{ $labels.broker }} of {{$labels.cluster}}: {{ $value }} ({{ $value | humanize }}B)"
    tags = F.create_map(F.lit("broker"), F.lit("kafka-1"))
    value = F.lit(2048.0)
    rendered = text.render_template(template, lambda n: labels.label(tags, n), text.plain_number(value), text.humanise(value))
    assert one(spark, rendered) == "kafka-1 of : 2048 (2.048kB)"
    with pytest.raises(ValueError):
        text.render_template("{{ $externalURL }}", lambda n: F.lit(""), F.lit("1"), F.lit("1"))


def test_trim_strips_unicode_space(spark):
    assert one(spark, text.normalise_category(F.col("v")), v="  \tToBacco \n") == "tobacco"


def test_contains_folds_cyrillic_and_nulls(spark):
    assert one(spark, text.contains_ci(F.lit("Ноутбук Dell"), "нОУТ"))
    assert not one(spark, text.contains_ci(F.lit(None).cast("string"), "x"))
    assert one(spark, text.contains_ci(F.lit(None).cast("string"), ""))
    assert not one(spark, text.any_contains_ci(F.lit(None).cast("array<string>"), "x"))


@pytest.mark.parametrize("duration, expected", [
    ("5 minutes", 300), ("1 minute", 60), ("30s", 30), ("5m", 300), ("2h", 7200), ("1 day", 86400), ("7 days", 604800), (42, 42),
    ("10 seconds", 10)])
def test_seconds(duration, expected):
    assert times.seconds(duration) == expected


@pytest.mark.parametrize("duration", ["", "five minutes", "5 parsecs", "-5m"])
def test_seconds_rejects(duration):
    with pytest.raises(ValueError):
        times.seconds(duration)


def test_times(spark):
    assert one(spark, times.parse_rfc3339(F.lit("no time"))) is None
    parsed = times.parse_rfc3339(F.lit("2024-01-10T08:00:00Z"))
    assert one(spark, times.format_rfc3339(parsed)) == "2024-01-10T08:00:00Z"
    assert one(spark, times.unix_nanos(parsed)) == 1704873600 * 10**9
    assert one(spark, times.format_rfc3339(times.parse_rfc3339(F.lit("2024-01-10T08:00:00+03:00")))) == "2024-01-10T05:00:00Z"


def test_labels(spark):
    tags = labels.label_map({"a": F.lit("1"), "b": F.lit(""), "c": F.lit(None).cast("string")})
    assert one(spark, labels.label_text(tags)) == "a=1"
    assert one(spark, labels.label_text(labels.add_label(tags, "a", F.lit("2")))) == "a=2"
    assert one(spark, labels.label_text(labels.add_label(tags, "a", F.lit("")))) == ""
    assert one(spark, labels.matches(tags, {"a": "1", "zz": ""}))
    assert not one(spark, labels.matches(tags, {"a": "1", "b": "x"}))
    assert one(spark, F.size(labels.label_map({}))) == 0


def test_env(monkeypatch):
    assert config.env("X", "d", {"X": ""}) == "d"
    assert config.env("X", "d", {"X": "v"}) == "v"
    found = config.StreamConfig.from_env({"TOPIC_IN": "events", "KAFKA_PASSWORD": "secret-word", "KAFKA_USER": "u"})
    assert (found.topic_in, found.topic_out, found.window) == ("events", "recommendations", "5 minutes")
    assert "secret-word" not in repr(found)
    assert config.StreamConfig.from_env({}).password is None


def test_decode_splits_every_message_once(spark):
    values = [
        '{"id":"a","price":1.5,"quantity":2,"tags":["x"],"unknown":1}', '{"id":"b"}', "{}", "oops", "", None,
        '{"id":"c","quantity":"many"}', '{"id":"d","price":[1]}', '["e"]', '{"id":"f"',
    ]
    messages = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    good = codec.decode(messages, schemas.PRODUCT, keep=("key",))
    bad = codec.dead_letters(messages, schemas.PRODUCT)
    assert sorted(r.key for r in good.collect()) == ["0", "1", "2"]
    assert {r.key: r.reason for r in bad.collect()} == {
        "3": "malformed", "4": "empty", "5": "empty", "6": "malformed", "7": "malformed", "8": "malformed", "9": "malformed"}
    empty = codec.zero_values(good).filter("key = '2'").first()
    assert (empty.id, empty.price, empty.quantity, empty.category) == ("", 0.0, 0, "")


def test_search_event_moves_its_argument(spark):
    rows = spark.createDataFrame(
        [("search", "кроссовки nike", None), ("view", "prod-001", ""), ("click", "prod-002", "user-7")],
        "kind string, arg string, user string")
    built = events.construct(rows, F.col("kind"), F.col("arg"), F.col("user"), F.timestamp_seconds(F.lit(1704873600)))
    found = {r.event_type: r for r in built.collect()}
    assert (found["search"].product_id, found["search"].query) == ("", "кроссовки nike")
    assert (found["view"].product_id, found["view"].query, found["view"].user_id) == ("prod-001", "", "user-demo-001")
    assert found["click"].user_id == "user-7"
    assert found["click"].event_id == "click-1704873600000000000"
    assert found["click"].timestamp == "2024-01-10T08:00:00Z"


@pytest.mark.parametrize(("value", "expected"), [("0", 0), ("-7", -7), ("+007", 7), ("9223372036854775807", 2**63 - 1), (None, None)])
def test_whole_number(spark, value, expected):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(text.whole_number(F.col("t"), "N")).first()[0] == expected


@pytest.mark.parametrize("value", ["", " 1", "1 ", "1.0", "1e3", "seven", "--1", "+", "9223372036854775808", "0x1", "1_000", "１"])
def test_whole_number_rejects(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    with pytest.raises(Exception, match="N is not a whole number"):
        df.select(text.whole_number(F.col("t"), "N")).collect()
