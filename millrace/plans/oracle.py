"""The same queries in DuckDB's SQL, over the given tables as views."""

from __future__ import annotations

HOUR = 3_600_000
DAY = 24 * HOUR
WITHIN = 6 * HOUR
AS_OF = 1_704_067_200_000

_PAGES = """
WITH raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_type IN ('signup', 'view') AS entry
  FROM events
), pages AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN entry THEN '1' ELSE '0' END AS is_new,
         'v' || (k % 3) AS vc, 'c' || (k % 5) AS ch, 'a' || (user_id % 4) AS ar,
         event_type AS page_id, CASE WHEN NOT entry THEN 'prev' END AS last_page_id,
         CAST(round(value * 100) AS BIGINT) AS during_time,
         CASE WHEN event_type = 'signup' THEN props END AS start,
         k % 4 AS n_displays, epoch_us(ts) // 1000 AS ts, entry
  FROM raw
)
"""

_DAY_TEXT = "strftime(epoch_ms(ts), '%Y-%m-%d')"

_REPAIRED = f"""{_PAGES}, repaired AS (
  SELECT * REPLACE (
    CASE WHEN is_new = '1'
          AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1
         THEN '0' ELSE is_new END AS is_new)
  FROM pages
)
"""

_VISITS = f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, {_DAY_TEXT} ORDER BY ts, seq) AS rn
  FROM {{src}} WHERE entry
) WHERE rn = 1
"""

_JUMPS = f"""SELECT *, CASE WHEN n_ts IS NULL OR n_ts - ts >= {WITHIN} THEN 'timeout'
                            WHEN n_entry THEN 'match' END AS outcome
  FROM (SELECT *, lead(ts) OVER w AS n_ts, lead(entry) OVER w AS n_entry
        FROM {{src}} WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
  WHERE entry AND (n_ts IS NULL OR n_ts - ts >= {WITHIN} OR n_entry)
"""


def _stats(closed: str = "", src: str = "repaired") -> str:
    return f"""{_REPAIRED}, rows AS (
  SELECT vc, ch, ar, is_new, 1 AS uv, 0 AS pv, 0 AS sv, 0 AS uj, 0 AS dur, ts
  FROM ({_VISITS.format(src=src)})
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM ({_JUMPS.format(src=src)})
  UNION ALL SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN entry THEN 1 ELSE 0 END, 0,
                   during_time, ts FROM {src}
)
SELECT strftime(epoch_ms(d * {DAY}), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(epoch_ms((d + 1) * {DAY}), '%Y-%m-%d %H:%M:%S') AS edt,
       vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
       CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
       CAST(sum(dur) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM (SELECT *, ts // {DAY} AS d FROM rows)
{closed}
GROUP BY d, vc, ch, ar, is_new
"""


_ORDER_FEED = """
WITH feed AS (
  SELECT o_orderkey AS seq, o_orderkey % 3 AS kind, o_orderkey AS id, o_custkey AS user_id,
         o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(16, 2)) AS total
  FROM orders
), images AS (
  SELECT *,
    rtrim(rtrim(CAST(total AS VARCHAR), '0'), '.') AS total_text,
    '{"id":' || id || ',"user_id":' || user_id || ',"status":"new"}' AS old_image,
    '{"id":' || id || ',"user_id":' || user_id || ',"status":"' || status
      || '","total":' || total_text || '}' AS new_image,
    CASE kind WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type
  FROM feed
)
"""

_CURRENT = """
SELECT id, part FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS part, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC,
                    l_extendedprice DESC) AS rn
  FROM lineitem
) WHERE rn = 1 AND l_returnflag <> 'R'
"""

_TOPIC_LINES = _ORDER_FEED + """
SELECT 'dwd_orders' AS topic,
       '{"id":' || id || ',"user_id":' || user_id || ',"total":' || total_text || '}' AS value
FROM images WHERE type = 'insert'
UNION ALL
SELECT 'dwd_orders_changed', '{"id":' || id || ',"status":"' || status || '"}'
FROM images WHERE type = 'update'
"""

_UPSERTED = """
SELECT CAST(o_custkey AS VARCHAR) AS id, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
       arg_max(o_orderpriority, (o_orderdate, o_orderkey))
         FILTER (WHERE o_orderpriority <> '5-LOW') AS priority
FROM orders GROUP BY o_custkey
"""

_SIDES = f"""
WITH info AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16, 2)) AS total_amount,
         CAST(NULL AS DECIMAL(16, 2)) AS activity_reduce_amount,
         CAST(0 AS DECIMAL(16, 2)) AS coupon_reduce_amount,
         CAST(o_totalprice AS DECIMAL(16, 2)) AS original_total_amount,
         CAST(NULL AS DECIMAL(16, 2)) AS feight_fee,
         strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS expire_time,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         strftime(o_orderdate, '%H') AS create_hour, epoch_ms(o_orderdate) AS create_ts
  FROM orders
), detail AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_extendedprice AS DECIMAL(16, 2)) AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, 'line ' || l_linenumber AS sku_name,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(l_extendedprice AS DECIMAL(16, 2)) AS split_total_amount,
         CAST(l_discount AS DECIMAL(16, 2)) AS split_activity_amount,
         CAST(l_tax AS DECIMAL(16, 2)) AS split_coupon_amount, epoch_ms(l_shipdate) AS create_ts
  FROM lineitem
), payment AS (
  SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
         CAST(CAST(o_totalprice AS DECIMAL(16, 2)) + 1 AS DECIMAL(16, 2)) AS total_amount,
         o_orderpriority AS subject, o_orderstatus AS payment_type,
         strftime(o_orderdate + to_minutes(o_orderkey % 30), '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(NULL AS VARCHAR) AS callback_time,
         epoch_ms(o_orderdate + to_minutes(o_orderkey % 30)) AS create_ts
  FROM orders
)
"""


def _order_wide(interval: str = "", parts: str = "TRUE", how: str = "LEFT") -> str:
    """CTEs ending in ``order_wide``."""
    return f"""{_SIDES}, sku AS (
  SELECT p_partkey AS id, p_name, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS spu_id,
         CAST(p_size AS BIGINT) AS tm_id, CAST(length(p_type) AS BIGINT) AS category3_id
  FROM part WHERE {parts}
), spu AS (
  SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id, p_brand FROM part
), category3 AS (
  SELECT CAST(length(p_type) AS BIGINT) AS id, min(p_type) AS name FROM part GROUP BY 1
), users AS (
  SELECT c_custkey AS id, CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS gender,
         CAST(({AS_OF} - epoch_ms(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER)))
              // 31536000000 AS INTEGER) AS age
  FROM customer
), order_wide AS (
  SELECT d.id AS detail_id, i.id AS order_id, d.sku_id, d.order_price, d.sku_num,
         coalesce(s.p_name, d.sku_name) AS sku_name, i.province_id, i.order_status, i.user_id,
         i.total_amount, i.activity_reduce_amount, i.coupon_reduce_amount,
         i.original_total_amount, i.feight_fee,
         CAST(NULL AS DECIMAL(16, 2)) AS split_feight_fee, d.split_activity_amount,
         d.split_coupon_amount, d.split_total_amount, i.expire_time, i.create_time,
         i.operate_time, i.create_date, i.create_hour, n.n_name AS province_name,
         r.r_name AS province_area_code, 'N' || n.n_nationkey AS province_iso_code,
         'R' || n.n_regionkey AS province_3166_2_code, u.age AS user_age,
         u.gender AS user_gender, s.spu_id, s.tm_id, s.category3_id, spu.p_brand AS spu_name,
         t.s_name AS tm_name, c.name AS category3_name, i.create_ts
  FROM info i JOIN detail d ON i.id = d.order_id {interval}
  {how} JOIN users u ON u.id = i.user_id
  {how} JOIN nation n ON n.n_nationkey = i.province_id
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  {how} JOIN sku s ON s.id = d.sku_id
  {how} JOIN spu ON spu.id = s.spu_id
  {how} JOIN supplier t ON t.s_suppkey = s.tm_id
  {how} JOIN category3 c ON c.id = s.category3_id
)
"""


_FIVE_DAYS = f"AND d.create_ts - i.create_ts BETWEEN {-5 * DAY} AND {5 * DAY}"

_WIDE = "SELECT * EXCLUDE (create_ts) FROM order_wide"

_PAID = """
SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time,
       p.callback_time, w.detail_id, p.order_id, w.sku_id, w.order_price, w.sku_num, w.sku_name,
       w.province_id, w.order_status, p.user_id, p.total_amount, w.activity_reduce_amount,
       w.coupon_reduce_amount, w.original_total_amount, w.feight_fee, w.split_feight_fee,
       w.split_activity_amount, w.split_coupon_amount, w.split_total_amount,
       w.create_time AS order_create_time, w.province_name, w.province_area_code,
       w.province_iso_code, w.province_3166_2_code, w.user_age, w.user_gender, w.spu_id, w.tm_id,
       w.category3_id, w.spu_name, w.tm_name, w.category3_name
FROM payment p JOIN order_wide w ON p.order_id = w.order_id
 AND w.create_ts - p.create_ts BETWEEN -900000 AND 5000"""

# Of lines 0, 4 or 8 seconds after their order the interval of the job keeps the first two.
_NEAR = "AND d.id % 10 % 3 < 2"

_PAYMENT_INTERVAL = f"""
SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id
FROM events p JOIN events v ON p.user_id = v.user_id
 AND epoch_us(v.ts) // 1000 - epoch_us(p.ts) // 1000 BETWEEN {-15 * HOUR} AND {5 * HOUR}
WHERE p.event_type = 'purchase' AND v.event_type = 'view'
"""

ORACLE: dict[str, str] = {
    "parse_events": f"""{_PAGES}
SELECT seq, mid, is_new, vc, ch, ar, page_id, last_page_id, during_time, start,
       CAST(n_displays AS INTEGER) AS n_displays, ts FROM pages""",
    "dirty_records": "SELECT props AS value FROM events WHERE event_type = 'error'",
    "entry_pages": f"{_PAGES} SELECT seq, mid, ts FROM pages WHERE last_page_id IS NULL",
    "repair_is_new": f"{_REPAIRED} SELECT seq, mid, ts, is_new FROM repaired",
    "log_split_counts": f"""{_PAGES}
SELECT 'start' AS side, count(*) AS n FROM pages WHERE start IS NOT NULL
UNION ALL SELECT 'page', count(*) FROM pages WHERE start IS NULL
UNION ALL SELECT 'display', CAST(sum(n_displays) AS BIGINT) FROM pages WHERE start IS NULL""",
    "split_lines": f"""{_REPAIRED}
SELECT CASE WHEN start IS NULL THEN 'dwd_page_log' ELSE 'dwd_start_log' END AS topic, mid, is_new, 'u' || seq AS uid,
       'p' || seq AS page_item, CAST(seq AS VARCHAR) AS action, CAST(seq AS VARCHAR) AS err, CAST(ts AS VARCHAR) AS ts,
       start IS NOT NULL AS start, NULL AS shown, page_id
FROM repaired
UNION ALL
SELECT 'dwd_display_log', NULL, NULL, NULL, NULL, NULL, NULL, NULL, false, 'i' || n, page_id
FROM pages, unnest(range(1, n_displays + 1)) AS u(n) WHERE start IS NULL""",
    "start_logs": f"{_PAGES} SELECT seq, mid, ts, start FROM pages WHERE start IS NOT NULL",
    "display_explode": f"""{_PAGES}
SELECT 'i' || n AS item, CAST(n AS BIGINT) AS "order", page_id,
       '{{"item":"i' || n || '","order":' || n || ',"ad":' || (n = 2) || ',"page_id":"' || page_id || '"}}' AS value
FROM pages, unnest(range(1, n_displays + 1)) AS u(n) WHERE start IS NULL""",
    "display_lines": f"""{_PAGES}
SELECT '{{"item":"i' || n || '","order":' || n || ',"ad":' || (n = 2) || ',"page_id":"' || page_id || '"}}' AS value
FROM pages, unnest(range(1, n_displays + 1)) AS u(n) WHERE start IS NULL""",
    "unique_visits": f"{_PAGES} SELECT seq, mid, ts FROM ({_VISITS.format(src='pages')})",
    "user_jumps": f"{_PAGES} SELECT seq, mid, ts FROM ({_JUMPS.format(src='pages')})",
    "jump_outcomes": f"{_PAGES} SELECT seq, mid, ts, outcome FROM ({_JUMPS.format(src='pages')})",
    "consecutive_3": f"""{_PAGES}
SELECT seq, mid, ts FROM (
  SELECT *, lead(entry, 1) OVER w AS e1, lead(entry, 2) OVER w AS e2, lead(ts, 2) OVER w AS t2
  FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
WHERE entry AND e1 AND e2 AND t2 - ts < {DAY}""",
    "visitor_stats": _stats(),
    "cdc_normalize": _ORDER_FEED + """
SELECT seq, 'shop' AS database, 'orders' AS "tableName",
       CASE WHEN kind = 0 THEN '{}' ELSE old_image END AS before,
       CASE WHEN kind = 2 THEN '{}' ELSE new_image END AS after, type FROM images""",
    "cdc_drop_deletes": _ORDER_FEED + """
SELECT type, count(*) AS n FROM images WHERE type <> 'delete' GROUP BY type""",
    "cdc_changelog": _ORDER_FEED + """
SELECT seq, TRUE AS is_add, CAST(id AS VARCHAR) AS id, status FROM images WHERE kind <> 2
UNION ALL SELECT seq, FALSE, CAST(id AS VARCHAR), 'new' FROM images WHERE kind <> 0""",
    "cdc_current": _CURRENT,
    "cdc_sql": _CURRENT,
    "cdc_snapshot_feed": _ORDER_FEED + """
SELECT 'customer' AS "tableName", 'read' AS type, count(*) AS n FROM customer
UNION ALL SELECT 'orders', type, count(*) FROM images GROUP BY type""",
    "route_kafka": _TOPIC_LINES,
    "route_dim": """
SELECT 'dim_part' AS sink_table, 'id' AS sink_pk, 'update' AS type,
       '{"id":' || p_partkey || ',"name":"' || p_name || '"}' AS data FROM part""",
    "route_unmatched": """
SELECT 'ignored' AS reason, 'supplier' AS "tableName", 'insert' AS type,
       CAST(s_suppkey AS VARCHAR) AS id FROM supplier
UNION ALL SELECT 'unmatched', 'customer', 'read', CAST(c_custkey AS VARCHAR) FROM customer""",
    "topic_round_trip": _TOPIC_LINES,
    "dim_upsert": _UPSERTED,
    "chain_dim_upsert": _UPSERTED,
    "chain_order_wide": _order_wide(_NEAR) + "SELECT * EXCLUDE (create_ts, user_age) FROM order_wide",
    "chain_payment_wide": _order_wide(_NEAR) + f"SELECT * EXCLUDE (user_age) FROM ({_PAID})",
    "chain_cdc_current": _CURRENT,
    "feed_latest": _ORDER_FEED + "SELECT id, type FROM images WHERE id % 2 = 1",
    "feed_since": _ORDER_FEED + "SELECT id, type FROM images WHERE id % 2 = 1",
    "stream_snapshot_feed": f"""
WITH l AS (
  SELECT *, strftime(l_shipdate, '%Y%m%d') >= '19960101' AS later, row_number() OVER (
      PARTITION BY l_orderkey, strftime(l_shipdate, '%Y%m%d') >= '19960101'
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
  FROM lineitem
), n AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, count(*) FILTER (NOT later AND rn = 1 AND l_returnflag <> 'R') AS n_read,
         count(*) FILTER (later) AS n_changed
  FROM l GROUP BY 1
)
SELECT n.*, part FROM n LEFT JOIN ({_CURRENT}) USING (id) WHERE n_read + n_changed > 0""",
    "route_rule_changes": _ORDER_FEED + """
SELECT 'dwd_orders' AS topic, 'orders:' || id AS key, '{"id":' || id || ',"user_id":' || user_id || '}' AS value
FROM images WHERE type = 'insert' AND id % 2 = 0
UNION ALL
SELECT 'dwd_orders_changed', 'orders:' || id, '{"id":' || id || ',"status":"' || status || '"}'
FROM images WHERE type = 'update' AND id % 2 = 0
UNION ALL
SELECT 'dwd_orders_v2', 'orders:' || id, '{"id":' || id || ',"total":' || total_text || '}'
FROM images WHERE type = 'insert' AND id % 2 = 1""",
    "order_detail_interval": f"""{_SIDES}
SELECT i.id AS order_id, d.id AS detail_id, i.create_time AS order_time,
       d.create_time AS detail_time
FROM info i JOIN detail d ON i.id = d.order_id {_FIVE_DAYS}""",
    "payment_interval": _PAYMENT_INTERVAL,
    "interval_exclusive": f"""{_SIDES}
SELECT i.id AS order_id, d.id AS detail_id
FROM info i JOIN detail d ON i.id = d.order_id
 AND d.create_ts - i.create_ts > {-5 * DAY} AND d.create_ts - i.create_ts < {5 * DAY}""",
    "order_wide": _order_wide() + _WIDE,
    "order_wide_interval": _order_wide(_FIVE_DAYS) + _WIDE,
    "order_wide_missing_dim": _order_wide(parts="p_size <= 40") + _WIDE,
    "order_wide_inner": _order_wide(parts="p_size <= 40", how="INNER") + _WIDE,
    "payment_wide": _order_wide() + _PAID,
    "coalesce_merge": f"""{_SIDES}
SELECT i.id, coalesce(i.order_status, p.payment_type) AS order_status,
       coalesce(i.create_time, p.create_time) AS create_time,
       coalesce(i.feight_fee, p.total_amount) AS feight_fee,
       coalesce(i.total_amount, p.total_amount) AS total_amount, i.activity_reduce_amount
FROM info i JOIN payment p ON i.id = p.order_id""",
    "user_age": f"""
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CAST(({AS_OF} - epoch_ms(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER)))
            // 31536000000 AS INTEGER) AS age FROM customer""",
    "date_parts": f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS create_date, strftime(ts, '%H') AS create_hour,
       epoch_ms(date_trunc('second', ts)) AS epoch_ms, epoch_us(ts) // 1000 AS fallback_ms,
       strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       epoch_ms(date_trunc('second', ts)) - {8 * HOUR} AS fixed_zone_ms
FROM events""",
    "dim_table_camel": """
SELECT c_custkey AS "cCustkey", c_name AS "cName", c_nationkey AS "cNationkey",
       c_mktsegment AS "cMktsegment" FROM customer""",
    "dim_point_lookup": """
SELECT CAST(p_partkey AS VARCHAR) AS "ID", p_name AS "SKU_NAME",
       split_part(p_brand, '#', 2) AS "SPU_ID", CAST(p_size AS VARCHAR) AS "TM_ID",
       CAST(length(p_type) AS VARCHAR) AS "CATEGORY3_ID" FROM part WHERE p_partkey = 7""",
    "stream_repair_is_new": f"{_REPAIRED} SELECT seq, mid, ts, is_new FROM repaired",
    "stream_unique_visits": f"{_PAGES} SELECT seq, mid, ts FROM ({_VISITS.format(src='pages')})",
    "stream_unique_visits_dedup": f"""{_PAGES}
SELECT DISTINCT mid, {_DAY_TEXT} AS day FROM pages WHERE entry""",
    # A stream holds back what the watermark (latest time less the delay) has not passed.
    "stream_jumps": f"""{_PAGES}
SELECT seq, mid, ts, outcome FROM ({_JUMPS.format(src='pages')})
WHERE ts + {WITHIN} <= (SELECT max(ts) FROM pages) - {2 * HOUR}""",
    "stream_interval": _PAYMENT_INTERVAL,
    "stream_stats": _stats(
        f"WHERE (d + 1) * {DAY} <= (SELECT max(ts) FROM pages) - {9 * HOUR}", "pages"
    ),
    "stream_dim_upsert": _UPSERTED,
    "stream_consecutive_3": f"""{_PAGES}
SELECT seq, mid, ts, outcome FROM (
  SELECT *, CASE WHEN t1 IS NULL OR t1 - ts >= {DAY} THEN 'timeout' WHEN NOT e1 THEN NULL
                 WHEN t2 IS NULL OR t2 - ts >= {DAY} THEN 'timeout' WHEN e2 THEN 'match' END AS outcome
  FROM (SELECT *, lead(entry, 1) OVER w AS e1, lead(ts, 1) OVER w AS t1, lead(entry, 2) OVER w AS e2,
               lead(ts, 2) OVER w AS t2
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)))
WHERE entry AND outcome IS NOT NULL AND ts + {DAY} <= (SELECT max(ts) FROM pages) - {2 * HOUR}""",
    "late_rows": f"""{_PAGES}, dealt AS (
  SELECT seq, CASE WHEN seq % 50 <> 7 THEN ts END AS ts,
         least(CAST(floor(seq * 4 / (SELECT max(event_id) + 1 FROM events)) AS BIGINT)
               + CASE WHEN seq % 10 = 3 THEN 1 ELSE 0 END, 3) AS file
  FROM pages
), highs AS (
  SELECT file, max(max(ts)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
  FROM dealt GROUP BY file
)
SELECT seq, CASE WHEN ts IS NULL THEN 'untimed' WHEN ts < high - {2 * HOUR} THEN 'late' ELSE 'on time' END AS reason
FROM dealt JOIN highs USING (file)""",
    "log_file_lines": f"{_PAGES} SELECT mid, page_id, ts FROM pages",
    "delimited_rows": "SELECT event_id, event_type, epoch_us(ts) // 1000 AS ts FROM events",
    "raw_change_texts": """
SELECT '{"topic":"feed.shop.customer_state","op":"u","after":{"id":' || o_custkey || ',"status":"' || o_orderstatus || '"'
  || CASE WHEN o_orderpriority <> '5-LOW' THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END
  || '},"source":{"file":"' || strftime(o_orderdate, '%Y%m%d') || '","pos":' || o_orderkey || '}}' AS value FROM orders""",
    "stored_windows": _stats(),
}
