"""SQL that answers the registered queries on the same tables, in another engine's dialect (DuckDB).

Written from the operators' definitions, not from their plans: windows by arithmetic instead of ``window()``,
lookups by grid and ``ASOF JOIN`` instead of spans, ranks over the full ordering.
"""

from __future__ import annotations

TS = "strftime(date_trunc('second', {}), '%Y-%m-%dT%H:%M:%SZ')"
K = "cast(json_extract_string(props, '$.k') as bigint)"

CLIENT_EVENTS = f"""
client_events AS (
  SELECT event_id AS seq, ts, event_type || '-' || event_id AS event_id, event_type,
         printf('user-%03d', user_id) AS user_id,
         CASE WHEN event_type IN ('view', 'click', 'purchase')
              THEN 'prod-' || lpad(json_extract_string(props, '$.k'), 3, '0') ELSE '' END AS product_id,
         '' AS query, {TS.format('ts')} AS timestamp,
         user_id % 3 AS part,
         CASE event_type WHEN 'view' THEN 'client-events' WHEN 'click' THEN 'products-raw'
              WHEN 'purchase' THEN 'products-filtered' WHEN 'signup' THEN 'heartbeats.internal'
              WHEN 'error' THEN '__consumer_offsets' END AS topic
  FROM events)"""

EVENT_JSON = ("cast(to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id, "
              "'product_id': product_id, 'query': query, 'timestamp': timestamp}) AS varchar)")


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select


def epoch(ts: str) -> str:
    return f"cast(floor(epoch({ts})) as bigint)"


def window_rows(size: int, slide: int) -> str:
    """Each product event once per window it falls in."""
    copies = -(-size // slide)
    return f"""
window_rows AS (
  SELECT * FROM (
    SELECT (s // {slide}) * {slide} - i * {slide} AS w, s, user_id, product_id
    FROM (SELECT {epoch('ts')} AS s, user_id, product_id FROM client_events WHERE product_id <> '')
    CROSS JOIN range(0, {copies}) AS r(i))
  WHERE w + {size} > s)"""


def bound(expr: str) -> str:
    return f"strftime(make_timestamp(cast({expr} as bigint) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def window_bounds(size: int) -> str:
    return f"{bound('w')} AS window_start, {bound(f'w + {size}')} AS window_end"


def counts(size: int, slide: int) -> str:
    return with_ctes(CLIENT_EVENTS, window_rows(size, slide), select=f"""
SELECT {window_bounds(size)}, user_id, product_id, count(*) AS n
FROM window_rows GROUP BY w, user_id, product_id""")


def ranked(size: int, slide: int, per_user: bool = True) -> list[str]:
    user = ", user_id" if per_user else ""
    return [CLIENT_EVENTS, window_rows(size, slide), f"""
ranked AS (
  SELECT w{user}, product_id, n, row_number() OVER (PARTITION BY w{user} ORDER BY n DESC, product_id) AS rank
  FROM (SELECT w{user}, product_id, count(*) AS n FROM window_rows GROUP BY w{user}, product_id))"""]


def top_k(size: int, slide: int, per_user: bool = True) -> str:
    user = "user_id, " if per_user else ""
    return with_ctes(*ranked(size, slide, per_user), select=f"""
SELECT {window_bounds(size)}, {user}product_id, n, rank FROM ranked WHERE rank <= 5""")


def lists(size: int, slide: int, where: str = "") -> str:
    return with_ctes(*ranked(size, slide), select=f"""
SELECT {window_bounds(size)}, user_id, string_agg(product_id, ',' ORDER BY rank) AS product_ids
FROM ranked WHERE rank <= 5 {where} GROUP BY w, user_id""")


DAY = 86400

DAMAGED = f"""
damaged AS (
  SELECT seq, ts, user_id, product_id,
         CASE WHEN seq % 97 = 0 THEN substr({EVENT_JSON}, 1, 20) WHEN seq % 101 = 0 THEN ''
              WHEN seq % 103 = 0 THEN NULL ELSE {EVENT_JSON} END AS value,
         seq % 97 = 0 OR seq % 101 = 0 OR seq % 103 = 0 AS dead
  FROM client_events)"""

RECOMMENDATION_MESSAGES = """
daily AS (
  SELECT w, user_id, list(product_id ORDER BY rank) AS ids FROM ranked WHERE rank <= 5 GROUP BY w, user_id),
read_back AS (
  SELECT *, day(make_timestamp(w * 1000000)) % 7 = 0 AS odd FROM daily)"""

RECOMMENDATIONS = {
    "event_decode": with_ctes(CLIENT_EVENTS, select="""
SELECT topic, event_id, event_type, user_id, product_id, query, timestamp FROM client_events"""),
    "event_construct": f"""
SELECT kind || '-' || cast(epoch_us(ts) * 1000 AS varchar) AS event_id, kind AS event_type,
       CASE WHEN user_id % 10 = 0 THEN 'user-demo-001' ELSE printf('user-%03d', user_id) END AS user_id,
       CASE WHEN kind = 'search' THEN '' ELSE arg END AS product_id,
       CASE WHEN kind = 'search' THEN arg ELSE '' END AS query,
       {TS.format('ts')} AS timestamp
FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 'search' ELSE event_type END AS kind,
             'item ' || json_extract_string(props, '$.k') AS arg FROM events)""",
    "event_keying": with_ctes(CLIENT_EVENTS, select=f"""
SELECT user_id AS key, {EVENT_JSON} AS value FROM client_events"""),
    "event_key_order": with_ctes(CLIENT_EVENTS, select="""
SELECT user_id AS key, count(*) AS n, count(*) AS in_order, max(seq) AS newest FROM client_events GROUP BY user_id"""),
    "event_dead_letters": with_ctes(CLIENT_EVENTS, DAMAGED, select="""
SELECT user_id AS key, seq, value AS raw,
       CASE WHEN value IS NULL OR value = '' THEN 'empty' ELSE 'malformed' END AS reason
FROM damaged WHERE dead"""),
    "event_activity": with_ctes(CLIENT_EVENTS, DAMAGED, select=f"""
SELECT user_id, product_id, {TS.format('ts')} AS event_time FROM damaged WHERE NOT dead AND product_id <> ''"""),
    "events_with_product": with_ctes(CLIENT_EVENTS, select="""
SELECT event_id, event_type, user_id, product_id, query, timestamp FROM client_events WHERE product_id <> ''"""),
    "event_time_parse": f"""
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE {epoch('ts')} END AS event_seconds FROM events""",
    "dedup_events": with_ctes(CLIENT_EVENTS, select="""
SELECT event_id, event_type, user_id, product_id, query, timestamp FROM client_events"""),
    "late_rows": f"""
WITH arriving AS (
  SELECT event_id, event_id // 500 AS batch,
         {epoch('ts')} - CASE WHEN event_id % 40 = 7 THEN 172800 ELSE 0 END AS s FROM events),
marked AS (
  SELECT a.event_id, a.batch, a.s, (SELECT max(b.s) - 600 FROM arriving b WHERE b.batch < a.batch) AS mark
  FROM arriving a)
SELECT event_id, batch, {bound('mark')} AS watermark FROM marked WHERE (s // 120) * 120 + 300 <= mark""",
    "late_stream": f"""
WITH arriving AS (
  SELECT event_id, least(event_id * 4 // (SELECT count(*) FROM events), 3) AS batch,
         {epoch('ts')} - CASE WHEN event_id % 40 = 7 THEN 172800 ELSE 0 END AS s FROM events),
marks AS (SELECT batch, lag(high) OVER (ORDER BY batch) - 600 AS mark
          FROM (SELECT batch, max(max(s)) OVER (ORDER BY batch) AS high FROM arriving GROUP BY batch))
SELECT event_id, coalesce((s // 120) * 120 + 300 <= mark, false) AS late,
       CASE WHEN (s // 120) * 120 + 300 <= mark THEN {bound('mark')} END AS watermark
FROM arriving JOIN marks USING (batch)""",
    "sliding_counts_5m_2m": counts(300, 120),
    "sliding_counts_1d_12h": counts(DAY, DAY // 2),
    "sliding_counts_7d_1d": counts(7 * DAY, DAY),
    "tumbling_counts_1d": counts(DAY, DAY),
    "recommend_topk_user": top_k(7 * DAY, DAY),
    "recommend_topk_user_5m": top_k(300, 120),
    "recommend_topk_global": top_k(7 * DAY, DAY, per_user=False),
    "recommend_topk_global_5m": top_k(300, 120, per_user=False),
    "recommend_lists": lists(7 * DAY, DAY),
    "recommend_json": with_ctes(*ranked(7 * DAY, DAY), select=f"""
SELECT user_id AS key,
       cast(to_json({{'user_id': user_id, 'product_ids': list(product_id ORDER BY rank),
                     'window_start': {bound('w')}, 'window_end': {bound(f'w + {7 * DAY}')}}}) AS varchar) AS value
FROM ranked WHERE rank <= 5 GROUP BY w, user_id"""),
    "recommend_stream_update": lists(7 * DAY, DAY),
    "recommend_stream_append": lists(
        7 * DAY, DAY, f"AND w + {7 * DAY} <= (SELECT max(s) - 600 FROM window_rows)"),
    "recommendation_read": with_ctes(*ranked(DAY, DAY), RECOMMENDATION_MESSAGES, select=f"""
SELECT {bound('w')} AS window_start,
       CASE WHEN odd THEN NULL ELSE user_id END AS user_id,
       CASE WHEN odd THEN NULL ELSE array_to_string(ids, ',') END AS product_ids,
       CASE WHEN odd THEN NULL ELSE '2024-02-01T00:00:00Z' END AS generated_at,
       CASE WHEN odd THEN 'plain text for ' || user_id END AS raw
FROM read_back"""),
    "recommendation_stream_read": with_ctes(*ranked(DAY, DAY), RECOMMENDATION_MESSAGES, select="""
SELECT CASE WHEN odd THEN NULL ELSE user_id END AS user_id, CASE WHEN odd THEN NULL ELSE '2024-02-01T00:00:00Z' END AS generated_at,
       CASE WHEN odd THEN 'plain text for ' || user_id END AS raw, CASE WHEN odd THEN NULL ELSE i END AS position,
       CASE WHEN odd THEN NULL ELSE ids[i] END AS product_id
FROM (SELECT *, unnest(range(1, CASE WHEN odd THEN 2 ELSE len(ids) + 1 END)) AS i FROM read_back)"""),
    "recommendation_numbered": with_ctes(*ranked(DAY, DAY), RECOMMENDATION_MESSAGES, select=f"""
SELECT {bound('ranked.w')} AS window_start, user_id, '2024-02-01T00:00:00Z' AS generated_at,
       rank AS position, product_id
FROM ranked WHERE rank <= 5 AND day(make_timestamp(w * 1000000)) % 7 <> 0"""),
}


CATALOGUE_ROWS = """
catalog AS (
  SELECT p_partkey AS k, printf('prod-%03d', p_partkey) AS id, p_name AS name,
         CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN 'Promo' ELSE lower(p_type) END AS category,
         p_name || ' ' || lower(p_type) AS description, p_retailprice AS price, 'RUB' AS currency,
         cast(p_size AS bigint) AS quantity, 'seller-' || (p_partkey % 10) AS seller_id, p_brand AS brand,
         p_name AS tags, '2024-01-10T08:00:00Z' AS created_at
  FROM part)"""

PRODUCT_COLUMNS = "id, name, category, description, price, currency, quantity, seller_id, brand, tags, created_at"
IS_BANNED = "coalesce(category IN ('promo', 'small'), false)"
PRODUCT_JSON = ("cast(to_json({'id': id, 'name': name, 'category': coalesce(category, ''), 'description': description, "
                "'price': price, 'currency': currency, 'quantity': quantity, 'seller_id': seller_id, 'brand': brand, "
                "'tags': string_split(tags, ' '), 'created_at': created_at}) AS varchar)")
CATEGORY_LINE = "coalesce(category, '')"

NUMBERED = f"""
numbered AS (
  SELECT topic, part AS partition, seq AS "offset", user_id AS key, {EVENT_JSON} AS value, ts
  FROM client_events)"""

LAGS = """
lags AS (
  SELECT DISTINCT user_id AS "group", topic, part AS partition,
         max(seq) OVER (PARTITION BY topic, part) + 1 AS log_end_offset,
         max(seq) OVER (PARTITION BY user_id, topic, part) + 1 AS current_offset
  FROM client_events)"""

TABLE_BANNED = "SELECT lower(p_name) AS category FROM part WHERE p_size >= 45"


def search(word: str) -> str:
    columns = ["name", "description", "category", "brand"]
    hit = " OR ".join(f"coalesce(contains(lower({c}), '{word}'), false)" for c in columns)
    tag = f"list_bool_or(list_transform(string_split(tags, ' '), lambda t: contains(lower(t), '{word}')))"
    return f"({hit} OR {tag})"


def listing(word: str) -> str:
    return with_ctes(CATALOGUE_ROWS, select=f"""
SELECT id, '[' || id || '] ' || name AS title,
       'Category: ' || coalesce(category, '') || ' | Brand: ' || brand || ' | Price: '
         || printf('%.2f', price) || ' ' || currency AS details,
       description
FROM catalog WHERE {search(word)}""")


CATALOGUE = {
    "catalog_publish": with_ctes(CATALOGUE_ROWS, select=f"SELECT id AS key, {PRODUCT_JSON} AS value FROM catalog"),
    "catalog_decode": with_ctes(CATALOGUE_ROWS, select="""
SELECT id, CASE WHEN bare THEN '' ELSE name END AS name, CASE WHEN bare THEN '' ELSE coalesce(category, '') END AS category,
       CASE WHEN bare THEN 0.0::double ELSE price END AS price, CASE WHEN bare THEN 0 ELSE quantity END AS quantity,
       CASE WHEN bare THEN '' ELSE brand END AS brand
FROM (SELECT *, k % 61 = 0 AS bare FROM catalog WHERE k % 53 <> 0 AND k % 59 <> 0)"""),
    "catalog_dead_letters": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT id AS key, CASE WHEN k % 53 = 0 THEN replace({PRODUCT_JSON}, '"quantity":' || quantity, '"quantity":"many"')
                       ELSE '{{' || {PRODUCT_JSON} END AS raw, 'malformed' AS reason
FROM catalog WHERE k % 53 = 0 OR k % 59 = 0"""),
    "catalog_passed": with_ctes(CATALOGUE_ROWS, select=f"SELECT {PRODUCT_COLUMNS} FROM catalog WHERE NOT {IS_BANNED}"),
    "catalog_filtered": with_ctes(CATALOGUE_ROWS, select=f"SELECT {PRODUCT_COLUMNS} FROM catalog WHERE {IS_BANNED}"),
    "catalog_passed_normalised": with_ctes(CATALOGUE_ROWS, select="""
SELECT id, category FROM catalog WHERE coalesce(lower(trim(category)), '') NOT IN ('promo', 'small')"""),
    "catalog_passed_messages": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT 'key-' || id AS key, {PRODUCT_JSON} AS value FROM catalog WHERE NOT {IS_BANNED}"""),
    "catalog_screen_by_brand": """
SELECT CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_brand = 'Brand#7') THEN 'FILTERED' ELSE 'PASSED' END AS status,
       p_name AS category, count(*) AS n
FROM part GROUP BY 1, 2""",
    "catalog_audit": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT id, CASE WHEN {IS_BANNED} THEN 'FILTERED' ELSE 'PASSED' END AS status,
       CASE WHEN {IS_BANNED} THEN 'FILTERED [' || id || '] ' || name || ' (category=' || {CATEGORY_LINE} || '): banned category'
            ELSE 'PASSED  [' || id || '] ' || name || ' (category=' || {CATEGORY_LINE} || ') -> products-filtered' END AS line
FROM catalog"""),
    "catalog_audit_tally": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT CASE WHEN {IS_BANNED} THEN 'FILTERED' ELSE 'PASSED' END AS status, category, count(*) AS n FROM catalog GROUP BY 1, 2"""),
    "catalog_stream_screen": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT id AS key, CASE WHEN {IS_BANNED} THEN 'FILTERED' ELSE 'PASSED' END AS status, coalesce(category, '') AS category
FROM catalog"""),
    "catalog_stream_passed": with_ctes(CATALOGUE_ROWS, select=f"SELECT {PRODUCT_COLUMNS} FROM catalog WHERE NOT {IS_BANNED}"),
    "banned_list": f"SELECT DISTINCT category FROM ({TABLE_BANNED})",
    "banned_add": f"{TABLE_BANNED} UNION SELECT lower(p_name) FROM part WHERE p_size = 1",
    "banned_remove": f"{TABLE_BANNED} EXCEPT SELECT lower(p_name) FROM part WHERE p_size <= 2",
    "catalog_search": listing("widget"),
    "catalog_search_words": listing("red widget"),
    "catalog_search_indexed": listing("red widget"),
    "catalog_search_count": with_ctes(CATALOGUE_ROWS, select=f"SELECT count(*) AS found FROM catalog WHERE {search('widget')}"),
    "catalog_search_all": "SELECT count(*) AS found FROM part",
    "catalog_search_tags": with_ctes(CATALOGUE_ROWS, select="""
SELECT id, tags FROM catalog
WHERE list_bool_or(list_transform(string_split(tags, ' '), lambda t: contains(lower(t), 'bol')))"""),
    "product_receipts": with_ctes(CATALOGUE_ROWS, select="""
SELECT receipt, id, printf('[%4d] -> ', receipt) || id || ' | ' || rpad(name, cast(greatest(40, length(name)) AS integer), ' ') || ' | '
       || printf('%.2f', price) AS line
FROM (SELECT *, row_number() OVER (ORDER BY k) AS receipt FROM catalog)"""),
    "catalog_from_json": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT {PRODUCT_COLUMNS.replace('category', CATEGORY_LINE + ' AS category')} FROM catalog"""),
    "banned_from_file": f"SELECT DISTINCT category FROM ({TABLE_BANNED})",
    "file_sink_roundtrip": with_ctes(CATALOGUE_ROWS, select=f"SELECT {PRODUCT_COLUMNS} FROM catalog WHERE NOT {IS_BANNED}"),
    "file_sink_head": with_ctes(CATALOGUE_ROWS, select=f"""
SELECT id, name, price FROM catalog WHERE NOT {IS_BANNED} ORDER BY id LIMIT 5"""),
    "file_sink_count": with_ctes(CATALOGUE_ROWS, select=f"SELECT count(*) AS lines FROM catalog WHERE NOT {IS_BANNED}"),
    "mirror_topics": with_ctes(CLIENT_EVENTS, NUMBERED, select="""
SELECT 'cluster1.' || topic AS topic, partition, "offset", key, value FROM numbered
WHERE topic IN ('products-raw', 'products-filtered', 'client-events')"""),
    "mirror_all_but_excluded": with_ctes(CLIENT_EVENTS, select="""
SELECT 'backup.' || topic AS topic, part AS partition, count(*) AS n FROM client_events
WHERE topic NOT LIKE '%.internal' AND topic NOT LIKE '%-internal' AND NOT starts_with(topic, '__') GROUP BY 1, 2"""),
    "mirror_streamed": with_ctes(CLIENT_EVENTS, NUMBERED, select="""
SELECT 'cluster1.' || topic AS topic, partition, key, value FROM numbered
WHERE topic IN ('products-raw', 'products-filtered', 'client-events')"""),
    "partition_counts": with_ctes(CLIENT_EVENTS, select="""
SELECT topic, part AS partition, count(*) AS n, max(seq) + 1 AS log_end_offset FROM client_events GROUP BY topic, part"""),
    "consumer_lag": with_ctes(CLIENT_EVENTS, LAGS, select="""
SELECT "group", topic, partition, current_offset, log_end_offset, log_end_offset - current_offset AS lag FROM lags"""),
    "consumer_lag_stream": with_ctes(CLIENT_EVENTS, """
read AS (SELECT topic, part, max(seq) + 1 AS current_offset, count(*) AS n FROM client_events
         WHERE seq * 4 // (SELECT count(*) FROM events) < 3 GROUP BY topic, part)""", select="""
SELECT 'reader' AS "group", topic, part AS partition, current_offset, n, log_end_offset, log_end_offset - current_offset AS lag
FROM read JOIN (SELECT topic, part, max(seq) + 1 AS log_end_offset FROM client_events GROUP BY topic, part) USING (topic, part)"""),
    "whole_numbers": f"""
SELECT event_id, CASE WHEN event_id % 3 = 1 THEN -{K} ELSE {K} END AS k FROM events""",
    "marketplace_graph": with_ctes(CATALOGUE_ROWS, *ranked(300, 120), select=f"""
SELECT 'stored' AS kind, id AS key, NULL::bigint AS position, name AS value FROM catalog WHERE NOT {IS_BANNED}
UNION ALL SELECT 'listed', user_id, rank, product_id FROM ranked WHERE rank <= 5"""),
    "consumer_lag_total": with_ctes(CLIENT_EVENTS, LAGS, select="""
SELECT "group", topic, cast(sum(log_end_offset - current_offset) AS bigint) AS lag FROM lags GROUP BY "group", topic"""),
}


STEP = 6 * 3600
# Sample times are microseconds, ticks are seconds.
STEP_US, AGE_US, SPAN_US = STEP * 10**6, 12 * 3600 * 10**6, 86400 * 10**6


def moment(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%SZ')"



LABEL_COLUMNS = ["broker", "cluster", "grp", "instance", "job", "part", "topic"]
LABEL_NAMES = {"grp": "group", "part": "partition"}


def label_text(columns: list[str]) -> str:
    parts = ", ".join(f"'{LABEL_NAMES.get(c, c)}=' || nullif({c}, '')" for c in sorted(columns, key=lambda c: LABEL_NAMES.get(c, c)))
    return f"concat_ws(',', {parts})"


def _family(metric: str, value: str, broker: bool, topic: bool, lag: bool = False, part: bool = False) -> str:
    return (f"SELECT '{metric}' AS metric, s, {'broker' if broker else 'NULL'} AS broker, 'cluster-1' AS cluster, "
            f"{'grp' if lag else 'NULL'} AS grp, instance, 'kafka' AS job, {'part' if part else 'NULL'} AS part, "
            f"{'topic' if topic else 'NULL'} AS topic, {value} AS value FROM base")


SAMPLES = f"""
base AS (
  SELECT event_id, epoch_us(ts) AS s, 'kafka-' || (user_id % 3 + 1) AS broker, user_id % 3 + 1 AS b,
         'kafka-' || (user_id % 3 + 1) || ':910' || (user_id % 3 + 1) AS instance,
         CASE WHEN event_type = 'view' THEN 'products-raw' ELSE event_type END AS topic,
         CASE WHEN user_id % 2 = 0 THEN 'stream-processor' ELSE 'connect-filesink-group' END AS grp,
         cast(user_id % 3 AS varchar) AS part, value, event_type = 'error' AS is_error
  FROM events),
raw_samples AS (
  {_family('up', "CASE WHEN is_error THEN 0.0::double ELSE 1.0 END", True, False)}
  UNION ALL {_family('kafka_consumer_group_lag', "value * 10", False, True, lag=True, part=True)}
  UNION ALL {_family('kafka_server_replicamanager_underreplicatedpartitions',
                     "CASE WHEN is_error THEN floor(value / 10) ELSE 0.0 END", True, False)}
  UNION ALL {_family('kafka_controller_kafkacontroller_activecontrollercount',
                     "CASE WHEN b = 1 AND NOT is_error THEN 1.0::double ELSE 0.0 END", True, False)}
  UNION ALL {_family('kafka_log_log_size', "round(value * 1e8)", True, True, part=True)}
  UNION ALL {_family('kafka_server_brokertopicmetrics_MessagesInPerSec_OneMinuteRate', "value", True, True)}
  UNION ALL {_family('kafka_server_brokertopicmetrics_BytesInPerSec_OneMinuteRate', "round(value * 1000)", True, True)}),
samples AS (SELECT *, {label_text(LABEL_COLUMNS)} AS labels FROM raw_samples)"""

# One value per series and second, then the latest one at every tick.
INSTANT = f"""
single AS (
  SELECT metric, labels, s, {', '.join(f'any_value({c}) AS {c}' for c in LABEL_COLUMNS)}, max(value) AS value
  FROM samples GROUP BY metric, labels, s),
spans AS (
  SELECT metric, labels, (min(s) + {STEP_US} - 1) // {STEP_US} AS a, (max(s) + {AGE_US}) // {STEP_US} AS z
  FROM single GROUP BY metric, labels),
grid AS (SELECT metric, labels, unnest(range(a, z + 1)) * {STEP} AS t FROM spans),
instant AS (
  SELECT grid.metric, grid.labels, grid.t, {', '.join(f'single.{c}' for c in LABEL_COLUMNS)}, single.value
  FROM grid ASOF JOIN single ON grid.metric = single.metric AND grid.labels = single.labels AND grid.t * 1000000 >= single.s
  WHERE grid.t * 1000000 - single.s <= {AGE_US})"""

RATES = f"""
steps AS (
  SELECT *, CASE WHEN value >= before THEN value - before WHEN before IS NOT NULL THEN value ELSE 0 END AS inc
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, labels ORDER BY s) AS before FROM single))"""

TICK_RATES = f"""
inside AS (
  SELECT g.metric, g.labels, g.t, p.s, p.inc, p.topic, p.broker
  FROM grid g JOIN steps p ON g.metric = p.metric AND g.labels = p.labels AND p.s BETWEEN g.t * 1000000 - {SPAN_US} AND g.t * 1000000),
tick_rates AS (
  SELECT metric, labels, t, any_value(topic) AS topic, any_value(broker) AS broker,
         (sum(inc) - arg_min(inc, s)) / ((max(s) - min(s)) / 1e6) AS value
  FROM inside GROUP BY metric, labels, t HAVING max(s) > min(s))"""

# Ticks reach one span past the last sample for rates, not one age limit.
RATE_GRID = INSTANT.replace(f"(max(s) + {AGE_US})", f"(max(s) + {SPAN_US})")

BYTES = "metric = 'kafka_server_brokertopicmetrics_BytesInPerSec_OneMinuteRate'"
MESSAGES = "metric = 'kafka_server_brokertopicmetrics_MessagesInPerSec_OneMinuteRate'"
LAG = "metric = 'kafka_consumer_group_lag'"
EXACT_SUM = "round(sum(value), 2)"


def lag_by_topic(colour: bool = False, ctes: str = INSTANT, where: str = "") -> str:
    bands = "CASE WHEN value >= 1000 THEN 'red' WHEN value >= 100 THEN 'yellow' ELSE 'green' END"
    return with_ctes(SAMPLES, ctes, select=f"""
SELECT *, {bands} AS colour FROM (
  SELECT {bound('t')} AS ts, grp AS "group", topic, {EXACT_SUM} AS value
  FROM instant WHERE {LAG} {where} GROUP BY t, grp, topic)""")


def _rule_rows(alertname: str, metric: str, compare: str, by: list[str] | None, where: str = "true") -> str:
    if by is None:
        return f"""SELECT '{alertname}' AS alertname, labels, t, value, broker, cluster, NULL AS grp, NULL AS topic
  FROM instant WHERE metric = '{metric}' AND {where} AND value {compare}"""
    kept = {c: (c if c in by else "NULL") for c in ("broker", "cluster", "grp", "topic")}
    text = label_text(by) if by else "''"
    group = ", ".join(["t", *by])
    columns = ", ".join(f"{v} AS {c}" for c, v in kept.items())
    return f"""SELECT '{alertname}' AS alertname, {text} AS labels, t, {EXACT_SUM} AS value, {columns}
  FROM instant WHERE metric = '{metric}' AND {where} GROUP BY {group} HAVING sum(value) {compare}"""


RULE_ROWS = {
    "KafkaBrokerDown": _rule_rows("KafkaBrokerDown", "up", "= 0", None),
    "KafkaConsumerGroupLag": _rule_rows("KafkaConsumerGroupLag", "kafka_consumer_group_lag", "> 1000", ["grp", "topic"]),
    "KafkaUnderReplicatedPartitions": _rule_rows(
        "KafkaUnderReplicatedPartitions", "kafka_server_replicamanager_underreplicatedpartitions", "> 0", None),
    "KafkaNoActiveController": _rule_rows(
        "KafkaNoActiveController", "kafka_controller_kafkacontroller_activecontrollercount", "<> 1", []),
    "KafkaDiskUsageHigh": _rule_rows("KafkaDiskUsageHigh", "kafka_log_log_size", "> 10737418240", ["broker"]),
    "StreamProcessorDown": _rule_rows(
        "StreamProcessorDown", "kafka_consumer_group_lag", "> 100", ["grp"],
        "grp = 'stream-processor' AND topic = 'products-raw'"),
}
HOLD = {"KafkaBrokerDown": 21600, "KafkaConsumerGroupLag": 43200, "KafkaUnderReplicatedPartitions": 64800,
        "KafkaNoActiveController": 86400, "KafkaDiskUsageHigh": 108000, "StreamProcessorDown": 129600}
CRITICAL = "alertname IN ('KafkaBrokerDown', 'KafkaUnderReplicatedPartitions', 'KafkaNoActiveController')"
SEVERITY = f"CASE WHEN {CRITICAL} THEN 'critical' ELSE 'warning' END"
HOLD_OF = "CASE alertname " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in HOLD.items()) + " END"


def active(rows: list[str]) -> str:
    union = "\n  UNION ALL ".join(rows)
    # Runs of consecutive ticks: tick number less row number is constant inside a run.
    return f"""
active AS ({union}),
runs AS (
  SELECT *, t // {STEP} - row_number() OVER (PARTITION BY alertname, labels ORDER BY t) AS run FROM active),
states AS (
  SELECT *, {SEVERITY} AS severity, min(t) OVER (PARTITION BY alertname, labels, run) AS since,
         CASE WHEN t - min(t) OVER (PARTITION BY alertname, labels, run) >= {HOLD_OF} THEN 'firing' ELSE 'pending' END AS state
  FROM runs),
firing AS (SELECT * FROM states WHERE state = 'firing')"""


ALL_RULES = active(list(RULE_ROWS.values()))
FULL_LABELS = active([
    RULE_ROWS["KafkaBrokerDown"],
    _rule_rows("KafkaDiskUsageHigh", "kafka_log_log_size", "> 1e9", ["broker", "cluster"]),
])


def one_rule(alertname: str) -> str:
    return with_ctes(SAMPLES, INSTANT, active([RULE_ROWS[alertname]]), select=f"""
SELECT labels, {bound('t')} AS ts, value, {bound('since')} AS active_at, state FROM states""")


CHANGES = f"""
marked AS (
  SELECT *, lag(t) OVER w AS earlier, lead(t) OVER w AS later FROM firing
  WINDOW w AS (PARTITION BY alertname, labels ORDER BY t)),
changes AS (
  SELECT alertname, severity, labels, broker, cluster, t AS moment, 'firing' AS status FROM marked
  WHERE earlier IS NULL OR t - earlier > {STEP}
  UNION ALL
  SELECT alertname, severity, labels, broker, cluster, t + {STEP}, 'resolved' FROM marked
  WHERE later IS NULL OR later - t > {STEP})"""


NUMBER_TEXT = "regexp_replace(cast(value AS varchar), '\\.0$', '')"


def human(value: str) -> str:
    """Four significant digits and an SI suffix, for values from thousandths to billions."""
    def digits(scaled: str) -> str:
        places = f"CASE WHEN {scaled} >= 100 THEN 1 WHEN {scaled} >= 10 THEN 2 ELSE 3 END"
        return f"regexp_replace(cast(floor({scaled} * pow(10, {places}) + 0.5) / pow(10, {places}) AS varchar), '\\.0$', '')"

    ranges = [(1e9, "G"), (1e6, "M"), (1e3, "k"), (1.0, ""), (1e-3, "m")]
    cases = " ".join(f"WHEN {value} >= {low} THEN {digits(f'({value} / {low})')} || '{suffix}'" for low, suffix in ranges)
    return f"CASE WHEN {value} = 0 THEN '0' {cases} END"


BROKER, CLUSTER, GROUP, TOPIC = (f"coalesce({c}, '')" for c in ("broker", "cluster", "grp", "topic"))
# The texts that the rules give.
SUMMARY = f"""CASE alertname
  WHEN 'KafkaBrokerDown' THEN 'Kafka брокер ' || {BROKER} || ' недоступен'
  WHEN 'KafkaConsumerGroupLag' THEN 'Consumer group ' || {GROUP} || ' отстаёт в топике ' || {TOPIC}
  WHEN 'KafkaUnderReplicatedPartitions' THEN 'Под-реплицированные партиции на ' || {BROKER}
  WHEN 'KafkaNoActiveController' THEN 'Kafka: нет активного контроллера'
  WHEN 'KafkaDiskUsageHigh' THEN 'Kafka: высокое использование диска на ' || {BROKER}
  WHEN 'StreamProcessorDown' THEN 'Stream Processor остановлен или отстаёт' END"""
DESCRIPTION = f"""CASE alertname
  WHEN 'KafkaBrokerDown' THEN 'Брокер ' || {BROKER} || ' (cluster=' || {CLUSTER}
    || ') не отвечает более 1 минуты. Проверьте: docker logs ' || {BROKER}
  WHEN 'KafkaConsumerGroupLag' THEN 'Отставание: ' || {NUMBER_TEXT} || ' сообщений. Consumer группа ' || {GROUP}
    || ' не успевает обрабатывать сообщения из ' || {TOPIC} || '. Проверьте stream-processor.'
  WHEN 'KafkaUnderReplicatedPartitions' THEN {NUMBER_TEXT} || ' партиций не имеют полного набора реплик на брокере ' || {BROKER}
    || '. Это снижает надёжность (при отказе брокера данные могут быть потеряны).'
  WHEN 'KafkaNoActiveController' THEN 'Активных контроллеров: ' || {NUMBER_TEXT}
    || ' (должен быть ровно 1). Кластер не может обрабатывать metadata запросы. Проверьте KRaft quorum: docker logs kafka-1'
  WHEN 'KafkaDiskUsageHigh' THEN 'Брокер ' || {BROKER} || ' использует ' || {human('value')}
    || 'B дискового пространства. Рассмотрите уменьшение retention.ms или увеличение диска.'
  WHEN 'StreamProcessorDown' THEN 'Consumer group stream-processor отстаёт на ' || {NUMBER_TEXT}
    || ' сообщений в топике products-raw. Проверьте stream-processor.' END"""


AUDIBLE = f"""
annotated AS (SELECT *, {SUMMARY} AS summary, {DESCRIPTION} AS description FROM firing),
inhibited AS (
  SELECT *, severity = 'warning' AND EXISTS (
    SELECT 1 FROM firing f WHERE f.alertname = 'KafkaBrokerDown' AND f.t = a.t
      AND coalesce(f.cluster, '') = coalesce(a.cluster, '') AND coalesce(f.broker, '') = coalesce(a.broker, '')) AS inhibited
  FROM annotated a),
audible AS (SELECT * FROM inhibited WHERE NOT inhibited),
grouped AS (
  SELECT t, alertname AS group_alertname, coalesce(cluster, '') AS group_cluster, coalesce(broker, '') AS group_broker,
         count(*) AS n_alerts, CASE WHEN count(DISTINCT summary) = 1 THEN min(summary) ELSE '' END AS common_summary,
         list(string_split(labels, ',')) AS label_lists
  FROM audible GROUP BY 1, 2, 3, 4)"""

TOLD = f"""
told AS (
  SELECT t, alertname, labels, broker, cluster, summary, description, 'FIRING' AS status FROM audible
  UNION ALL
  SELECT t + {STEP}, alertname, labels, broker, cluster, summary, description, 'RESOLVED'
  FROM (SELECT *, lead(t) OVER (PARTITION BY alertname, labels ORDER BY t) AS later FROM audible)
  WHERE later IS NULL OR later - t > {STEP}),
parts AS (
  SELECT t, alertname AS group_alertname, coalesce(cluster, '') AS group_cluster, coalesce(broker, '') AS group_broker,
         labels, summary, status,
         '<b>Статус:</b> ' || status || chr(10) || '<b>Кластер:</b> ' || coalesce(cluster, '') || chr(10)
           || CASE WHEN coalesce(broker, '') <> '' THEN '<b>Брокер:</b> ' || broker ELSE '' END || chr(10)
           || '<b>Описание:</b> ' || description AS line
  FROM told),
whole AS (
  SELECT t, group_alertname, group_cluster, group_broker, bool_or(status = 'FIRING') AS fires,
         CASE WHEN count(DISTINCT summary) = 1 THEN min(summary) ELSE '' END AS common_summary
  FROM parts GROUP BY 1, 2, 3, 4)"""

NUMBER = "cast(user_id AS varchar)"
BEANS = f"""
beans AS (
  SELECT event_id, event_id % 13 AS form, event_type AS topic, {NUMBER} AS n,
         upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS attribute FROM events)"""

MONITORING = {
    "bean_to_metric": with_ctes(BEANS, select="""
SELECT event_id,
  CASE form
    WHEN 0 THEN 'kafka_server_brokertopicmetrics_MessagesInPerSec_' || attribute
    WHEN 1 THEN 'kafka_server_brokertopicmetrics_BytesInPerSec_OneMinuteRate'
    WHEN 2 THEN 'kafka_network_requestmetrics_fetchconsumer_TotalTimeMs_Mean'
    WHEN 3 THEN 'kafka_network_requestmetrics_produce_TotalTimeMs_Max'
    WHEN 4 THEN 'kafka_consumer_group_lag'
    WHEN 5 THEN 'kafka_server_replicamanager_underreplicatedpartitions'
    WHEN 6 THEN 'kafka_server_replicamanager_leadercount'
    WHEN 7 THEN 'kafka_server_replicamanager_partitioncount'
    WHEN 8 THEN 'kafka_controller_kafkacontroller_activecontrollercount'
    WHEN 9 THEN 'kafka_log_log_size'
    WHEN 10 THEN 'kafka_server_socket_server_connection_count'
    WHEN 11 THEN 'kafka_cluster_partition_insyncreplicas, topic=' || topic
  END AS metric,
  CASE form WHEN 1 THEN 'topic=' || topic
    WHEN 4 THEN 'client=c' || n || ',partition=' || n || ',topic=' || topic
    WHEN 9 THEN 'partition=' || n || ',topic=' || topic
    WHEN 10 THEN 'listener=SSL,processor=' || n
    WHEN 12 THEN NULL ELSE '' END AS labels
FROM beans"""),
    "metric_relabel": """
SELECT event_id, CASE WHEN user_id % 4 = 3 THEN 'cluster=cluster-1,instance=kafka-analytics:9104,job=kafka'
  ELSE 'broker=kafka-' || (user_id % 3 + 1) || ',cluster=cluster-1,instance=kafka-' || (user_id % 3 + 1) || ':910'
       || (user_id % 3 + 1) || ',job=kafka' END AS labels
FROM events""",
    "metric_instant": with_ctes(SAMPLES, INSTANT, select=f"SELECT metric, labels, {bound('t')} AS ts, value FROM instant"),
    "metric_matching": with_ctes(SAMPLES, select=f"""
SELECT {moment('s')} AS ts, labels, value FROM samples
WHERE {LAG} AND grp = 'stream-processor' AND topic = 'products-raw'"""),
    "metric_sum_by": with_ctes(SAMPLES, INSTANT, select=f"""
SELECT {bound('t')} AS ts, 'group=' || grp || ',topic=' || topic AS labels, {EXACT_SUM} AS value
FROM instant WHERE {LAG} GROUP BY t, grp, topic"""),
    "metric_sum_all": with_ctes(SAMPLES, INSTANT, select=f"""
SELECT {bound('t')} AS ts, {EXACT_SUM} AS value FROM instant WHERE {LAG} GROUP BY t"""),
    "metric_last": with_ctes(SAMPLES, select=f"""
SELECT metric, labels, {moment('s')} AS ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY metric, labels ORDER BY s DESC, value DESC) AS i FROM samples) WHERE i = 1"""),
    "metric_rate": with_ctes(SAMPLES, INSTANT, RATES, select=f"""
SELECT labels, {moment('s')} AS ts, value,
       round((sum(inc) OVER w - first_value(inc) OVER w) / nullif((s - first_value(s) OVER w) / 1e6, 0), 6) AS rate
FROM steps WHERE {BYTES}
WINDOW w AS (PARTITION BY labels ORDER BY s RANGE BETWEEN {SPAN_US} PRECEDING AND CURRENT ROW)"""),
    "metric_rate_at_ticks": with_ctes(SAMPLES, RATE_GRID, RATES, TICK_RATES, select=f"""
SELECT labels, {bound('t')} AS ts, round(value, 6) AS value FROM tick_rates WHERE {BYTES}"""),
    "dash_broker_status": with_ctes(SAMPLES, select="""
SELECT broker, value, CASE WHEN value = 0 THEN 'DOWN' ELSE 'UP' END AS status,
       CASE WHEN value >= 1 THEN 'green' ELSE 'red' END AS colour
FROM (SELECT *, row_number() OVER (PARTITION BY broker ORDER BY s DESC, value DESC) AS i FROM samples WHERE metric = 'up')
WHERE i = 1"""),
    "dash_under_replicated": with_ctes(SAMPLES, INSTANT, select=f"""
SELECT *, CASE WHEN value >= 1 THEN 'red' ELSE 'green' END AS colour
FROM (SELECT {bound('t')} AS ts, {EXACT_SUM} AS value FROM instant
      WHERE metric = 'kafka_server_replicamanager_underreplicatedpartitions' GROUP BY t)"""),
    "dash_lag": lag_by_topic(),
    "dash_last_days": lag_by_topic(ctes=INSTANT.replace("FROM samples GROUP BY", "FROM samples WHERE s >= (SELECT max(epoch_us(ts)) // 1000000 - 604800 FROM events) * 1000000 GROUP BY")),
    "dash_messages_by_topic": with_ctes(SAMPLES, RATE_GRID, RATES, TICK_RATES, select=f"""
SELECT {bound('t')} AS ts, topic, round(sum(value), 4) AS value
FROM tick_rates WHERE {MESSAGES} GROUP BY t, topic"""),
    "dash_bytes_by_broker": with_ctes(SAMPLES, RATE_GRID, RATES, TICK_RATES, select=f"""
SELECT {bound('t')} AS ts, broker, round(sum(value), 4) AS value
FROM tick_rates WHERE {BYTES} GROUP BY t, broker"""),
    "target_health": with_ctes(SAMPLES, select="""
SELECT job, instance, CASE WHEN value = 1 THEN 'up' ELSE 'down' END AS health
FROM (SELECT *, row_number() OVER (PARTITION BY job, instance ORDER BY s DESC, value DESC) AS i FROM samples WHERE metric = 'up')
WHERE i = 1"""),
    "alert_threshold": with_ctes(SAMPLES, INSTANT, ALL_RULES, select=f"SELECT alertname, labels, {bound('t')} AS ts, value FROM active"),
    "alert_broker_down": one_rule("KafkaBrokerDown"),
    "alert_consumer_lag": one_rule("KafkaConsumerGroupLag"),
    "alert_under_replicated": one_rule("KafkaUnderReplicatedPartitions"),
    "alert_no_controller": one_rule("KafkaNoActiveController"),
    "alert_disk_usage": one_rule("KafkaDiskUsageHigh"),
    "alert_processor_down": one_rule("StreamProcessorDown"),
    "alert_states": with_ctes(SAMPLES, INSTANT, ALL_RULES, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, value, {bound('since')} AS active_at, state, severity FROM states"""),
    "alert_hold_ticks": with_ctes(SAMPLES, INSTANT, f"""
ticks AS (
  SELECT t, 'group=' || grp || ',topic=' || topic AS labels, {EXACT_SUM} AS value
  FROM instant WHERE {LAG} GROUP BY t, grp, topic),
flagged AS (SELECT *, t // {STEP} - row_number() OVER (PARTITION BY labels, value > 300 ORDER BY t) AS run FROM ticks),
held AS (SELECT *, min(t) OVER (PARTITION BY labels, value > 300, run) AS since FROM flagged)""", select=f"""
SELECT {bound('t')} AS ts, labels, value, CASE WHEN value > 300 THEN {bound('since')} END AS active_at,
       CASE WHEN value <= 300 THEN 'inactive' WHEN t - since >= 86400 THEN 'firing' ELSE 'pending' END AS state
FROM held"""),
    "alert_transitions": with_ctes(SAMPLES, INSTANT, ALL_RULES, CHANGES, select=f"""
SELECT alertname, severity, labels, {bound('moment')} AS "at", status FROM changes"""),
    "alert_annotated": with_ctes(SAMPLES, INSTANT, ALL_RULES, AUDIBLE, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, value, summary, description FROM annotated"""),
    "alert_routed": with_ctes(SAMPLES, INSTANT, ALL_RULES, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, severity, 'telegram-notifications' AS receiver,
       CASE WHEN severity = 'critical' THEN 5 ELSE 30 END AS group_wait, 300 AS group_interval,
       CASE WHEN severity = 'critical' THEN 900 ELSE 7200 END AS repeat_interval
FROM firing"""),
    "alert_inhibited": with_ctes(SAMPLES, INSTANT, ALL_RULES, AUDIBLE, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, severity, inhibited FROM inhibited"""),
    "alert_inhibited_full_labels": with_ctes(SAMPLES, INSTANT, FULL_LABELS, AUDIBLE, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, severity, inhibited FROM inhibited"""),
    "alert_groups": with_ctes(SAMPLES, INSTANT, ALL_RULES, AUDIBLE, select=f"""
SELECT {bound('t')} AS ts, group_alertname, group_cluster, group_broker, n_alerts, common_summary,
       array_to_string(list_sort(list_reduce(label_lists, lambda a, b: list_intersect(a, b))), ',') AS common_labels
FROM grouped"""),
    "alert_messages": with_ctes(SAMPLES, INSTANT, ALL_RULES, AUDIBLE, TOLD, select=f"""
SELECT {bound('t')} AS ts, group_alertname, group_cluster, group_broker, 1 AS place, labels AS alert, line AS text FROM parts
UNION ALL
SELECT {bound('t')} AS ts, group_alertname, group_cluster, group_broker, 0, '',
       CASE WHEN fires THEN '🔴' ELSE '🟢' END || ' <b>' || group_alertname || '</b>' FROM whole
UNION ALL
SELECT {bound('t')} AS ts, group_alertname, group_cluster, group_broker, 2, '', '<i>Время: ' || common_summary || '</i>' FROM whole"""),
    "humanised_values": f"""
SELECT event_id, {human('v')} AS human
FROM (SELECT event_id, round(value, 0) * [0.001, 1.0, 1000.0, 1e6, 1e9][event_id % 5 + 1]::double AS v FROM events)""",
    "alert_stream_transitions": with_ctes(SAMPLES, INSTANT, ALL_RULES, CHANGES, select=f"""
SELECT alertname, severity, labels, {bound('moment')} AS "at", status FROM changes
WHERE moment <= (SELECT max({epoch('ts')}) // 21600 * 21600 FROM events)"""),
    "alert_clock_states": with_ctes(SAMPLES, INSTANT, ALL_RULES, select=f"""
SELECT alertname, labels, {bound('t')} AS ts, value, {bound('since')} AS active_at, state, severity FROM states
WHERE t <= (SELECT max(epoch_us(ts)) // 1000000 // {STEP} * {STEP} FROM events)"""),
}


def statements() -> dict[str, str]:
    return {**RECOMMENDATIONS, **CATALOGUE, **MONITORING}
