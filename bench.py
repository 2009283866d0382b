"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_QUERIES`` (names, comma
separated) choose what runs; ``BENCH_CHECKPOINT_DIR`` takes the intermediate tables (default: a new temporary folder). Each query is run once to warm up and then timed over all its rows, without
bringing them to the driver.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from marketstream.plans import registry
from marketstream.session import build_session

HEADLINE = [
    "event_decode", "event_activity", "events_with_product", "dedup_events",
    "sliding_counts_5m_2m", "sliding_counts_7d_1d", "tumbling_counts_1d",
    "recommend_topk_user", "recommend_topk_user_5m", "recommend_topk_global", "recommend_lists", "recommend_json",
    "recommend_stream_update", "recommend_stream_append",
    "catalog_passed", "catalog_audit_tally", "catalog_search", "catalog_search_count", "catalog_stream_screen",
    "file_sink_roundtrip", "mirror_topics", "consumer_lag",
    "metric_instant", "metric_sum_by", "metric_rate", "metric_rate_at_ticks", "dash_lag", "dash_bytes_by_broker",
    "bean_to_metric", "alert_states", "alert_transitions", "alert_inhibited", "alert_groups", "alert_messages",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
        spark__log__level="ERROR",
        spark__checkpoint__dir=os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"),
    )
    queries, took = registry.queries(), {}
    for name in names:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
