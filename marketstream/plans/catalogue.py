"""Catalogue and message queries over the ``part`` and ``events`` tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream import config, schemas
from marketstream.functions import codec, text
from marketstream.operators import control_set, mirror, numbering, offsets, ranking, screening, search
from marketstream.session import scratch_dir
from marketstream.sinks import files as file_sink
from marketstream.sinks import kafka as kafka_sink
from marketstream.sinks import triggered
from marketstream.sources import files, search_index, tables
from marketstream.streaming import mirror as mirror_stream
from marketstream.streaming import jobs, progress
from marketstream.streaming import screening as screening_stream

# The banned set that suits the table's categories.
BANNED = ["promo", "small"]


def banned_set(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in BANNED], "category string")


def flat(products: DataFrame) -> DataFrame:
    """Tags as text, so that results compare by value."""
    return products.withColumn("tags", F.array_join("tags", " "))


def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_sink.product_messages(tables.catalogue(spark, sf_dir))


def damaged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product messages of which some have a wrong type, a cut value or missing fields."""
    n = F.substring("key", 6, 20).cast("bigint")
    value = F.col("value")
    damaged = (
        F.when(n % 53 == 0, F.regexp_replace(value, r'"quantity":\d+', '"quantity":"many"'))
        .when(n % 59 == 0, F.concat(F.lit("{"), value))
        .when(n % 61 == 0, F.concat(F.lit('{"id":"'), F.col("key"), F.lit('","extra":1}')))
        .otherwise(value)
    )
    return catalog_publish(spark, sf_dir).withColumn("value", damaged)


def catalog_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable products; unknown fields are dropped and absent ones take empty values."""
    decoded = codec.decode(damaged_products(spark, sf_dir), schemas.PRODUCT)
    return codec.zero_values(flat(decoded)).select("id", "name", "category", "price", "quantity", "brand")


def catalog_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.dead_letters(damaged_products(spark, sf_dir), schemas.PRODUCT)


def catalog_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(screening.passed(tables.catalogue(spark, sf_dir), banned_set(spark)))


def catalog_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(screening.filtered(tables.catalogue(spark, sf_dir), banned_set(spark)))


def catalog_passed_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = screening.passed(tables.catalogue(spark, sf_dir), banned_set(spark), normalise=True)
    return found.select("id", "category")


def catalog_passed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys other than the id are kept as they came."""
    keyed = tables.catalogue(spark, sf_dir).withColumn("key", F.concat(F.lit("key-"), F.col("id")))
    return kafka_sink.passed_messages(screening.passed(keyed, banned_set(spark)))


def table_control_set(spark: SparkSession, sf_dir: str, rows: Column, name: Column) -> DataFrame:
    return tables.parts(spark, sf_dir).filter(rows).select(name.alias("category"))


def catalog_screen_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control set that grows with the table: names of the parts of one brand, checked by salted joins."""
    products = tables.catalogue(spark, sf_dir).withColumn("category", F.col("name"))
    names = table_control_set(spark, sf_dir, F.col("p_brand") == "Brand#7", F.col("p_name"))
    return screening.tally(screening.audit(products, names, small=False))


def catalog_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = screening.audit(tables.catalogue(spark, sf_dir), banned_set(spark))
    return screening.audit_line(audited).select("id", "status", "line")


def catalog_audit_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.tally(screening.audit(tables.catalogue(spark, sf_dir), banned_set(spark)))


def catalog_stream_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as a stream of messages, screened into tables; the audit table is returned."""
    work = scratch_dir(spark, "screen")
    messages = kafka_sink.product_messages(tables.catalogue(spark, sf_dir, streaming=True))
    query = screening_stream.start(messages, banned_set(spark), work, f"{work}/checkpoint", trigger=None)
    query.awaitTermination()
    return spark.read.parquet(f"{work}/audit").select("key", "status", "category")


def catalog_stream_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateless stream: allowed products straight to JSON lines."""
    work = scratch_dir(spark, "screen-lines")
    products = screening_stream.screen_stream(tables.catalogue(spark, sf_dir, streaming=True), banned_set(spark))
    file_sink.append_json_lines(products, f"{work}/lines", f"{work}/checkpoint").awaitTermination()
    return flat(files.json_lines(spark, f"{work}/lines", schemas.PRODUCT))


def as_json_array(rows: DataFrame, path: str) -> str:
    """Write a column of JSON values as files that each hold one array."""
    listed = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]"))
    # A fixed number of rows goes to each file, so none grows with the table; rows are dealt by place, as a value may repeat often.
    cut = rows.withColumn("_file", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 + rows.count() // 10_000)))
    # Without the limit a task writes all its groups into one file.
    cut.groupBy("_file").agg(listed.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def catalog_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue written as JSON arrays and read back as the shop does."""
    products = codec.zero_values(tables.catalogue(spark, sf_dir))
    path = as_json_array(products.select(F.to_json(F.struct(*products.columns)).alias("value")), scratch_dir(spark, "catalogue"))
    return flat(files.catalogue(spark, path))


def banned_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control set written as JSON arrays, with repeated names, and read back."""
    names = table_banned(spark, sf_dir).unionByName(table_banned(spark, sf_dir))
    path = as_json_array(names.select(F.to_json(F.struct("category")).alias("value")).select(
        F.regexp_extract("value", r"^\{\"category\":(.*)\}$", 1).alias("value")), scratch_dir(spark, "banned"))
    return files.control_set(spark, path)


def table_banned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_control_set(spark, sf_dir, F.col("p_size") >= 45, F.lower("p_name"))


def banned_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control_set.listing(table_banned(spark, sf_dir))


def banned_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts of size 1, written with blanks and capitals, join the set."""
    messy = F.concat(F.lit(" \t"), F.upper("p_name"), F.lit("  "))
    return control_set.add(table_banned(spark, sf_dir), table_control_set(spark, sf_dir, F.col("p_size") == 1, messy))


def banned_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = F.concat(F.lit(" "), F.initcap("p_name"))
    return control_set.remove(table_banned(spark, sf_dir), table_control_set(spark, sf_dir, F.col("p_size") <= 2, messy))


def catalog_search(query: str | list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return search.listing(search.search(tables.catalogue(spark, sf_dir), query))

    return run


def catalog_search_indexed(query: str | list[str]):
    """The catalogue written in parts with their signatures, and searched through them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = scratch_dir(spark, "search")
        search_index.build(tables.catalogue(spark, sf_dir), work, 64)
        return search.listing(search_index.find(spark, work, query))

    return run


def catalog_search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.found(search.search(tables.catalogue(spark, sf_dir), "WIDGET"))


def catalog_search_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.found(search.search(tables.catalogue(spark, sf_dir), ""))


def catalog_search_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = tables.catalogue(spark, sf_dir).filter(text.any_contains_ci(F.col("tags"), "Bol"))
    return flat(hits).select("id", "tags")


def product_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish log: running number, key, padded name and price."""
    products = tables.catalogue(spark, sf_dir).withColumn("seq", F.substring("id", 6, 20).cast("bigint"))
    numbered = numbering.number_rows(products, [], "seq", name="receipt", width=1000, start=1)
    return numbered.select(
        "receipt", "id",
        F.format_string("[%4d] -> %s | %s | %.2f", "receipt", "id", search.padded_name(), "price").alias("line"))


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    file_sink.append_json_lines(screening.passed(tables.catalogue(spark, sf_dir), banned_set(spark)), path)
    return files.json_lines(spark, path, schemas.PRODUCT)


def file_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(written_lines(spark, sf_dir))


def file_sink_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of the sink by id, a report."""
    return written_lines(spark, sf_dir).orderBy("id").limit(5).select("id", "name", "price")


def file_sink_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_lines(spark, sf_dir).agg(F.count("*").alias("lines"))


def readable(messages: DataFrame) -> DataFrame:
    columns = [c for c in messages.columns if c not in ("key", "value", "partition")]
    return messages.select(
        *columns,
        F.col("partition").cast("bigint").alias("partition"),
        codec.as_text(F.col("key")).alias("key"),
        codec.as_text(F.col("value")).alias("value"),
    )


def mirror_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(mirror.mirror(tables.messages(spark, sf_dir)).select("topic", "partition", "offset", "key", "value"))


def mirror_all_but_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No include list: the patterns alone decide."""
    return readable(mirror.mirror(tables.unnumbered_messages(spark, sf_dir), "backup", topics=None)
                    .select("topic", "partition", "key", "value")).groupBy("topic", "partition").agg(F.count("*").alias("n"))


def mirror_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "mirror")
    source = tables.unnumbered_messages(spark, sf_dir, streaming=True).drop("seq", "sent_at")
    mirror_stream.start_to_table(source, f"{work}/topics", f"{work}/checkpoint", trigger=None).awaitTermination()
    schema = "partition int, key string, value string, topic string"
    return readable(spark.read.schema(schema).parquet(f"{work}/topics"))


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user is a group that has come as far as its own newest message; users of other partitions have no offset there."""
    sent = tables.messages(spark, sf_dir).select(codec.as_text(F.col("key")).alias("group"), "topic", "partition", "offset")
    return sent.groupBy("group", "topic", "partition").agg((F.max("offset") + 1).alias("current_offset"))


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = offsets.partition_counts(tables.messages(spark, sf_dir))
    return found.withColumn("partition", F.col("partition").cast("bigint"))


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = offsets.partition_counts(tables.messages(spark, sf_dir))
    return offsets.consumer_lag(committed_offsets(spark, sf_dir), ends)


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags(spark, sf_dir).withColumn("partition", F.col("partition").cast("bigint"))


def consumer_lag_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.total_lag(lags(spark, sf_dir))


def consumer_lag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that has come through the first three quarters of the messages, by the offsets it committed, with a restart."""
    work, sent = scratch_dir(spark, "lag"), tables.messages(spark, sf_dir).drop("value")
    n = sent.count()
    quarter = F.least(F.floor(F.col("offset") * 4 / max(n, 1)), F.lit(3))
    for i in range(3):
        sent.filter(quarter == i).write.mode("append").parquet(f"{work}/topic")
        if i != 1:
            stream = spark.readStream.schema(sent.schema).parquet(f"{work}/topic")
            writer = stream.writeStream.option("checkpointLocation", f"{work}/checkpoint")
            read = progress.tracked(lambda batch, batch_id: None, f"{work}/offsets")
            triggered(writer.foreachBatch(read), None).start().awaitTermination()
    ends = offsets.partition_counts(sent)
    lag = offsets.consumer_lag(progress.committed(spark, f"{work}/offsets", "reader"), ends)
    return lag.withColumn("partition", F.col("partition").cast("bigint"))


def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in each event's properties, as text with and without a sign, read strictly."""
    number = F.get_json_object("props", "$.k")
    signed = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("+"), number)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("-00"), number)).otherwise(number)
    return tables.events(spark, sf_dir).select("event_id", text.whole_number(signed, "k").alias("k"))


def marketplace_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs run in turn over the tables' messages: what the store holds, and what readers of the lists see."""
    work = scratch_dir(spark, "graph")
    events_config = config.StreamConfig()
    products_config = config.ScreeningConfig(banned_path=f"{work}/banned")
    spark.createDataFrame([(json.dumps(BANNED),)], "value string").coalesce(1).write.text(f"{work}/banned")

    def put(name: str):
        as_bytes = [F.col(c).cast("binary").alias(c) for c in ("key", "value")]
        return lambda found: found.select(*as_bytes).write.mode("append").parquet(f"{work}/topics/{name}")

    def source(name: str):
        return lambda session: session.readStream.schema("key binary, value binary").parquet(f"{work}/topics/{name}")

    topics = [events_config.topic_in, events_config.topic_out, products_config.topic_in, products_config.topic_out]
    put(events_config.topic_in)(tables.unnumbered_messages(spark, sf_dir))
    put(products_config.topic_in)(catalog_publish(spark, sf_dir))
    send = {
        products_config.topic_out: put(products_config.topic_out),
        events_config.topic_out: lambda found: put(events_config.topic_out)(ranking.as_messages(found)),
    }
    jobs.marketplace(spark, events_config, products_config, work, {t: source(t) for t in topics}, send).run_in_turn()
    stored = spark.read.schema(schemas.PRODUCT).json(f"{work}/storage/products").select(
        F.lit("stored").alias("kind"), F.col("id").alias("key"), F.lit(None).cast("bigint").alias("position"), F.col("name").alias("value"))
    listed = spark.read.schema("user_id string, position bigint, product_id string").parquet(f"{work}/read-back/read").select(
        F.lit("listed").alias("kind"), F.col("user_id").alias("key"), "position", F.col("product_id").alias("value"))
    return stored.unionByName(listed)


QUERIES = {
    "catalog_publish": catalog_publish,
    "catalog_decode": catalog_decode,
    "catalog_dead_letters": catalog_dead_letters,
    "catalog_passed": catalog_passed,
    "catalog_filtered": catalog_filtered,
    "catalog_passed_normalised": catalog_passed_normalised,
    "catalog_passed_messages": catalog_passed_messages,
    "catalog_screen_by_brand": catalog_screen_by_brand,
    "catalog_audit": catalog_audit,
    "catalog_audit_tally": catalog_audit_tally,
    "catalog_stream_screen": catalog_stream_screen,
    "catalog_stream_passed": catalog_stream_passed,
    "catalog_from_json": catalog_from_json,
    "banned_from_file": banned_from_file,
    "banned_list": banned_list,
    "banned_add": banned_add,
    "banned_remove": banned_remove,
    "catalog_search": catalog_search("widget"),
    "catalog_search_words": catalog_search(["RED", "widget"]),
    "catalog_search_indexed": catalog_search_indexed(["RED", "widget"]),
    "catalog_search_count": catalog_search_count,
    "catalog_search_all": catalog_search_all,
    "catalog_search_tags": catalog_search_tags,
    "product_receipts": product_receipts,
    "file_sink_roundtrip": file_sink_roundtrip,
    "file_sink_head": file_sink_head,
    "file_sink_count": file_sink_count,
    "mirror_topics": mirror_topics,
    "mirror_all_but_excluded": mirror_all_but_excluded,
    "mirror_streamed": mirror_streamed,
    "partition_counts": partition_counts,
    "consumer_lag": consumer_lag,
    "consumer_lag_total": consumer_lag_total,
    "consumer_lag_stream": consumer_lag_stream,
    "whole_numbers": whole_numbers,
    "marketplace_graph": marketplace_graph,
}
