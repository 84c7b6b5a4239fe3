"""Plain SQL for the queries of the catalog, written for DuckDB on the same tables.

The statements say what a result is, by analytic functions over whole keys and by conditions on the
table columns; they share nothing with the Spark forms.
"""

# One event as a page record.
_PAGES = """
pages_ AS (
  SELECT event_id, ts AS event_ts, (epoch_us(ts) // 1000) AS ts, CAST(user_id AS VARCHAR) AS mid,
         CAST(user_id % 5 AS VARCHAR) AS ar, CAST(user_id % 3 AS VARCHAR) AS ch,
         CAST(user_id % 2 AS VARCHAR) AS vc,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
         event_type = 'view' AS entry, CAST(floor(value) AS BIGINT) AS during_time
  FROM events)"""

# Whether the log line of an event was damaged.
_DIRTY = "(event_id % 97 = 0 OR event_id % 89 = 1 OR event_id % 83 = 2)"
_IS_PAGE = "event_type <> 'signup'"

_UV = """
uv_ AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, CAST(event_ts AS DATE)
                                 ORDER BY event_ts, event_id) AS rn
    FROM pages_ WHERE entry)
  WHERE rn = 1)"""

_UJ = """
uj_ AS (
  SELECT *, CASE WHEN next_ts < event_ts + INTERVAL 30 MINUTE THEN 'match' ELSE 'timeout' END AS how
  FROM (
    SELECT *, lead(event_ts) OVER w AS next_ts, lead(entry) OVER w AS next_entry
    FROM pages_ WINDOW w AS (PARTITION BY mid ORDER BY event_ts, event_id))
  WHERE entry AND (next_ts IS NULL OR next_ts >= event_ts + INTERVAL 30 MINUTE OR next_entry))"""

_SESSIONS = """
WITH marked AS (
  SELECT user_id, ts,
         CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
FROM numbered GROUP BY user_id, no"""


def _visitor(bucket: str, width: str) -> str:
    return f"""
visitor_ AS (
  SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(b + INTERVAL {width}, '%Y-%m-%d %H:%M:%S') AS edt, vc, ch, ar, is_new,
         CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
         CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
         CAST(sum(dur) AS BIGINT) AS dur_sum, min(ts) AS ts
  FROM (
    SELECT {bucket} AS b, vc, ch, ar, is_new, ts, 1 AS uv, 0 AS pv, 0 AS sv, 0 AS uj, 0 AS dur
    FROM uv_
    UNION ALL
    SELECT {bucket}, vc, ch, ar, is_new, ts, 0, 0, 0, 1, 0 FROM uj_
    UNION ALL
    SELECT {bucket}, vc, ch, ar, is_new, ts, 0, 1, CASE WHEN entry THEN 1 ELSE 0 END, 0,
           during_time
    FROM pages_)
  GROUP BY b, vc, ch, ar, is_new)"""


_DAY = "date_trunc('day', event_ts)"
_TEN = "time_bucket(INTERVAL 10 SECOND, event_ts, TIMESTAMP '1970-01-01')"

_ORDER_WIDE = """
wide_ AS (
  SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
         l_extendedprice AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
         p_name AS sku_name, CAST(NULL AS DOUBLE) AS split_total_amount,
         l_discount AS split_activity_amount, l_tax AS split_coupon_amount,
         o_custkey % 30 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
         o_totalprice AS total_amount, CAST(NULL AS DOUBLE) AS activity_reduce_amount,
         CAST(NULL AS DOUBLE) AS coupon_reduce_amount,
         CAST(NULL AS DOUBLE) AS original_total_amount, CAST(NULL AS DOUBLE) AS feight_fee,
         CAST(NULL AS DOUBLE) AS feight_fee_reduce, CAST(NULL AS VARCHAR) AS expire_time,
         CAST(NULL AS VARCHAR) AS refundable_time,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         strftime(o_orderdate, '%H') AS create_hour,
         n.n_name AS province_name, CAST(n.n_regionkey AS VARCHAR) AS province_area_code,
         r.r_name || '-' || CAST(n.n_nationkey AS VARCHAR) AS province_3166_2_code,
         r.r_name AS province_iso_code,
         CAST(floor((DATE '2024-01-01' - (DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER)))
                    / 365.0) AS INTEGER) AS user_age,
         c_mktsegment AS user_gender, CAST(p_size AS BIGINT) AS spu_id,
         CAST(p_partkey % 120 AS BIGINT) AS tm_id, CAST(p_size % 7 AS BIGINT) AS category3_id,
         spu.n_name AS spu_name, s_name AS tm_name, cat.r_name AS category3_name
  FROM orders
  JOIN lineitem ON l_orderkey = o_orderkey
   AND l_shipdate > o_orderdate - INTERVAL 5 DAY AND l_shipdate < o_orderdate + INTERVAL 5 DAY
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation n ON n.n_nationkey = o_custkey % 30
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN nation spu ON spu.n_nationkey = p_size
  LEFT JOIN supplier ON s_suppkey = p_partkey % 120
  LEFT JOIN region cat ON cat.r_regionkey = p_size % 7)"""

_PAYMENT_WIDE = """
SELECT p.o_orderkey AS payment_id, p.o_orderpriority AS subject, p.o_orderstatus AS payment_type,
       CASE WHEN p.o_orderkey % 5 = 0 THEN 'unknown'
            ELSE strftime(p.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS payment_create_time,
       strftime(p.o_orderdate, '%Y-%m-%d %H:%M:%S') AS callback_time,
       detail_id, order_id, sku_id, order_price, sku_num, sku_name, province_id, order_status,
       user_id, total_amount, activity_reduce_amount, coupon_reduce_amount,
       original_total_amount, feight_fee, CAST(NULL AS DOUBLE) AS split_feight_fee,
       split_activity_amount, split_coupon_amount, split_total_amount,
       create_time AS order_create_time, province_name, province_area_code, province_iso_code,
       province_3166_2_code, user_age, user_gender, spu_id, tm_id, category3_id, spu_name,
       tm_name, category3_name
FROM orders p JOIN wide_ ON order_id = p.o_orderkey
 AND strptime(create_time, '%Y-%m-%d %H:%M:%S') > p.o_orderdate - INTERVAL 5 DAY
 AND strptime(create_time, '%Y-%m-%d %H:%M:%S') < p.o_orderdate + INTERVAL 5 DAY
WHERE p.o_orderstatus = 'F'"""

_MONTH = "time_bucket(INTERVAL 30 DAY, {0}, TIMESTAMP '1970-01-01')"

_PRODUCT_ROWS = """
rows_ AS (
  SELECT l_partkey AS sku_id, l_shipdate AS t, 0 AS display, 0 AS click, 0 AS favor, 0 AS cart,
         CAST(l_quantity AS BIGINT) AS num, 0 AS comment_, 0 AS good,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, 0 AS paid, 0 AS refund,
         l_orderkey AS o, NULL AS p, NULL AS f
  FROM lineitem
  UNION ALL
  SELECT l_partkey, l_shipdate, 0, 0, 0, 0, 0, 0, 0, 0,
         CAST(l_extendedprice AS DECIMAL(18,2)), 0, NULL, l_orderkey, NULL
  FROM lineitem WHERE l_linestatus = 'F'
  UNION ALL
  SELECT l_partkey, l_shipdate, 0, 0, 0, 0, 0, 0, 0, 0, 0,
         CAST(l_extendedprice AS DECIMAL(18,2)), NULL, NULL, l_orderkey
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT event_id % 1000, ts, CAST(event_type = 'view' AS INTEGER),
         CAST(event_type = 'click' AS INTEGER), CAST(event_type = 'signup' AS INTEGER),
         CAST(event_type = 'purchase' AS INTEGER), 0, CAST(event_type = 'error' AS INTEGER),
         CAST(event_type = 'error' AND value >= 50 AS INTEGER), 0, 0, 0, NULL, NULL, NULL
  FROM events
  WHERE event_type IN ('view', 'click', 'signup', 'purchase', 'error'))"""

_PRODUCT_STATS = f"""
stats_ AS (
  SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(b + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS edt, sku_id,
         CAST(sum(display) AS BIGINT) AS display_ct, CAST(sum(click) AS BIGINT) AS click_ct,
         CAST(sum(favor) AS BIGINT) AS favor_ct, CAST(sum(cart) AS BIGINT) AS cart_ct,
         CAST(sum(num) AS BIGINT) AS order_sku_num, CAST(sum(comment_) AS BIGINT) AS comment_ct,
         CAST(sum(good) AS BIGINT) AS good_comment_ct,
         CAST(sum(amount) AS DOUBLE) AS order_amount, CAST(sum(paid) AS DOUBLE) AS payment_amount,
         CAST(sum(refund) AS DOUBLE) AS refund_amount, count(DISTINCT o) AS order_ct,
         count(DISTINCT p) AS paid_order_ct, count(DISTINCT f) AS refund_order_ct,
         min((epoch_us(t) // 1000)) AS ts
  FROM (SELECT *, {_MONTH.format('t')} AS b FROM rows_) GROUP BY b, sku_id)"""


def _changes(name: str, key: str, ident: str, label: str, segment: str, cells: int) -> str:
    return f"""
  SELECT CAST({key} AS BIGINT) AS seq, 'shop' AS "database", '{name}' AS "table",
         CASE {key} % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete'
                        ELSE 'read' END AS type,
         {ident} AS id, {label} AS name, {segment} AS segment, {cells} AS cells,
         CAST({key} AS VARCHAR) AS k
  FROM {name}"""


_CHANGES = "changes_ AS (" + " UNION ALL ".join(
    [
        _changes("orders", "o_orderkey", "CAST(o_orderkey AS VARCHAR)", "NULL", "NULL", 3),
        _changes(
            "customer", "c_custkey", "CAST(c_custkey AS VARCHAR)", "c_name",
            "CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END", 3,
        ),
        _changes("supplier", "s_suppkey", "NULL", "s_name", "NULL", 2),
    ]
) + ")"

_LATEST = """
  SELECT CAST(o_custkey AS VARCHAR) AS id,
         arg_max(s, q) FILTER (s IS NOT NULL) AS status,
         arg_max(p, q) FILTER (p IS NOT NULL) AS priority,
         arg_max(d, q) FILTER (d IS NOT NULL) AS last_day
  FROM (
    SELECT o_custkey, o_orderkey AS q,
           CASE WHEN o_orderkey % 2 = 0 OR o_orderstatus <> 'P' THEN o_orderstatus END AS s,
           CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS p,
           CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d
    FROM orders)
  GROUP BY o_custkey"""

_SUMS = """CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity"""

_TOPIC_COUNTS = f"""
  SELECT 'dwd_start_log' AS topic, count(*) AS n FROM events
  WHERE NOT {_DIRTY} AND event_type = 'signup'
  UNION ALL
  SELECT 'dwd_page_log', count(*) FROM events WHERE NOT {_DIRTY} AND {_IS_PAGE}
  UNION ALL
  SELECT 'dwd_display_log', CAST(sum(event_id % 3) AS BIGINT) FROM events
  WHERE NOT {_DIRTY} AND event_type IN ('view', 'click')
  UNION ALL
  SELECT 'dwd_action_log', count(*) FROM events WHERE NOT {_DIRTY} AND event_type = 'purchase'
  UNION ALL
  SELECT 'dwd_error_log', count(*) FROM events WHERE NOT {_DIRTY} AND event_type = 'error'
  UNION ALL
  SELECT 'dwd_dirty_log', count(*) FROM events WHERE {_DIRTY}"""

ORACLE = {
    "interval_join_orders": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, l_orderkey, l_partkey, l_suppkey,
       l_linenumber, l_quantity, l_shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate > o_orderdate - INTERVAL 5 DAY AND l_shipdate < o_orderdate + INTERVAL 5 DAY""",
    "interval_join_inclusive": """
SELECT o_orderkey, o_orderdate, l_orderkey, l_partkey, l_linenumber, l_shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY""",
    "interval_join_payment": """
SELECT p.event_id AS purchase_id, p.ts AS purchase_ts, c.event_id AS click_id, c.user_id,
       c.ts AS click_ts
FROM events p JOIN events c ON p.user_id = c.user_id
 AND c.ts > p.ts - INTERVAL 15 MINUTE AND c.ts < p.ts + INTERVAL 100 SECOND
WHERE p.event_type = 'purchase' AND c.event_type = 'click'""",
    "order_merge": f"""
WITH {_ORDER_WIDE}
SELECT order_id, detail_id, sku_id, create_time, create_date, create_hour, total_amount,
       order_price
FROM wide_""",
    "order_wide": f"WITH {_ORDER_WIDE} SELECT * FROM wide_",
    "payment_wide": f"WITH {_ORDER_WIDE} {_PAYMENT_WIDE}",
    "lookup_user": """
SELECT o_orderkey AS id, o_custkey AS user_id, c_mktsegment AS user_gender,
       CAST(floor((DATE '2024-01-01' - (DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER)))
                  / 365.0) AS INTEGER) AS user_age
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "lookup_province": """
SELECT o_orderkey AS id, o_custkey % 30 AS province_id, n_name AS name,
       CAST(n_regionkey AS VARCHAR) AS area_code, r_name AS iso_code,
       r_name || '-' || CAST(n_nationkey AS VARCHAR) AS iso2
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30
LEFT JOIN region ON r_regionkey = n_regionkey""",
    "lookup_product": """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS id, l_partkey AS sku_id,
       p_name AS sku_name, CAST(p_size AS BIGINT) AS spu_id, n_name AS spu_name,
       CAST(p_partkey % 120 AS BIGINT) AS tm_id, s_name AS tm_name,
       CAST(p_size % 7 AS BIGINT) AS category3_id, r_name AS category3_name
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN nation ON n_nationkey = p_size
LEFT JOIN supplier ON s_suppkey = p_partkey % 120
LEFT JOIN region ON r_regionkey = p_size % 7""",
    "lookup_miss": """
SELECT d.doc_id, lang, source, n_chars, quality, toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "log_dirty": f"SELECT event_id FROM events WHERE {_DIRTY}",
    "log_split_counts": f"SELECT * FROM ({_TOPIC_COUNTS}) WHERE n > 0",
    "log_pages": f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS mid,
       CASE WHEN event_type <> 'error' THEN event_type END AS page_id,
       CASE WHEN event_type NOT IN ('error', 'view') THEN 'home' END AS last_page_id,
       CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS during_time,
       strftime(ts, '%Y-%m-%d') AS day, (epoch_us(ts) // 1000) AS ts
FROM events WHERE NOT {_DIRTY} AND {_IS_PAGE}""",
    "log_starts": f"""
SELECT event_id, 'icon' AS entry, event_id % 1000 AS loading_time, '1' AS is_new
FROM events WHERE NOT {_DIRTY} AND event_type = 'signup'""",
    "display_explode": f"""
SELECT event_id, 'query' AS display_type, CAST(event_id + i AS VARCHAR) AS item,
       'sku_id' AS item_type, i AS "order", user_id % 4 AS pos_id, event_type AS page_id
FROM (SELECT *, unnest(range(1, event_id % 3 + 1)) AS i FROM events
      WHERE NOT {_DIRTY} AND event_type IN ('view', 'click'))""",
    "action_explode": f"""
SELECT event_id, 'buy' AS action_id, (epoch_us(ts) // 1000) AS ts, 'purchase' AS page_id
FROM events WHERE NOT {_DIRTY} AND event_type = 'purchase'""",
    "error_records": f"""
SELECT event_id, event_id % 7 AS error_code, 'failed' AS msg
FROM events WHERE NOT {_DIRTY} AND event_type = 'error'""",
    "base_log_messages": f"""
SELECT topic, n, CAST(CASE WHEN topic = 'dwd_start_log' THEN
         (SELECT count(DISTINCT user_id) FROM events
          WHERE NOT {_DIRTY} AND event_type = 'signup') ELSE 0 END AS BIGINT) AS new_ct
FROM ({_TOPIC_COUNTS}) WHERE n > 0""",
    "entry_predicate": "SELECT event_id, event_type = 'view' AS is_entry FROM events",
    "dirty_rate": f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS total_ct,
       CAST(sum(CAST({_DIRTY} AS INTEGER)) AS BIGINT) AS dirty_ct,
       avg(CAST({_DIRTY} AS INTEGER)) AS dirty_rate
FROM events GROUP BY 1""",
    "new_visitor_fix": f"""
WITH {_PAGES}
SELECT event_id, event_ts, mid,
       CASE WHEN is_new = '1' AND
                 row_number() OVER (PARTITION BY mid, is_new ORDER BY event_ts, event_id) = 1
            THEN '1' ELSE '0' END AS is_new
FROM pages_""",
    "unique_visit": f"""
WITH {_PAGES}, {_UV}
SELECT event_id, mid, strftime(event_ts, '%Y-%m-%d') AS day, ts FROM uv_""",
    "user_jump": f"WITH {_PAGES}, {_UJ} SELECT event_id, mid, ts, how FROM uj_",
    "session_count": _SESSIONS,
    "session_window_count": _SESSIONS,
    "running_total": """
SELECT event_id, user_id,
       CAST(sum(length(props)) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM events""",
    "running_count": """
SELECT event_id, user_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
FROM events""",
    "key_counts": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "partition_counts": """
SELECT l_linenumber, CAST(1 AS BIGINT) AS parts, count(*) AS n FROM lineitem GROUP BY 1""",
    "snapshot_records": """
SELECT 'shop' AS database, 'customer' AS "table", 'read' AS type,
       CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(0 AS INTEGER) AS before_cells
FROM customer""",
    "visitor_stats": f"""
WITH {_PAGES}, {_UV}, {_UJ}, {_visitor(_DAY, '1 DAY')} SELECT * FROM visitor_""",
    "visitor_stats_10s": f"""
WITH {_PAGES}, {_UV}, {_UJ}, {_visitor(_TEN, '10 SECOND')} SELECT * FROM visitor_""",
    "product_stats": f"WITH {_PRODUCT_ROWS}, {_PRODUCT_STATS} SELECT * FROM stats_",
    "product_stats_sources": f"WITH {_PRODUCT_ROWS}, {_PRODUCT_STATS} SELECT * FROM stats_",
    "product_stats_named": f"""
WITH {_PRODUCT_ROWS}, {_PRODUCT_STATS}
SELECT stt, edt, sku_id, p_name AS sku_name, CAST(p_size AS BIGINT) AS spu_id,
       n_name AS spu_name, CAST(p_partkey % 120 AS BIGINT) AS tm_id, s_name AS tm_name,
       CAST(p_size % 7 AS BIGINT) AS category3_id, r_name AS category3_name, order_ct,
       order_amount
FROM stats_ LEFT JOIN part ON p_partkey = sku_id LEFT JOIN nation ON n_nationkey = p_size
LEFT JOIN supplier ON s_suppkey = p_partkey % 120 LEFT JOIN region ON r_regionkey = p_size % 7""",
    "product_union": f"""
WITH {_PRODUCT_ROWS}
SELECT sku_id, count(*) AS n, CAST(sum(num) AS BIGINT) AS order_sku_num,
       CAST(sum(amount) AS DOUBLE) AS order_amount, CAST(sum(click) AS BIGINT) AS click_ct
FROM rows_ GROUP BY sku_id""",
    "cdc_normalize": f"""
WITH {_CHANGES}
SELECT seq, "database", "table", type, id, name, segment,
       CAST(CASE WHEN type = 'update' THEN cells ELSE 0 END AS BIGINT) AS before_cells,
       CAST(cells AS BIGINT) AS after_cells
FROM changes_ WHERE type <> 'delete'""",
    "cdc_lines_roundtrip": f"""
WITH {_CHANGES}
SELECT "table", type, count(*) AS n,
       CAST(sum(CASE WHEN type = 'delete' THEN 0 ELSE cells END) AS BIGINT) AS cells
FROM changes_ GROUP BY "table", type""",
    "route_by_rules": f"""
WITH {_CHANGES},
rules_(t, o, sink_type, sink_table, rowkey, cells) AS (VALUES
  ('orders', 'insert', 'kafka', 'dwd_order_info', 'id', 'id,status'),
  ('orders', 'update', 'clickhouse', 'olap_orders', 'id', 'id,priority'),
  ('customer', 'insert', 'hbase', 'dim_user', 'id', 'id,name,segment'),
  ('customer', 'update', 'hbase', 'dim_user', 'id', 'id,segment'),
  ('supplier', 'insert', 'hbase', 'dim_supplier', 'supplier_id', 'name,supplier_id'))
SELECT seq, "table", type, coalesce(sink_type, 'unmatched') AS sink_type, sink_table, rowkey,
       CASE WHEN sink_type IS NOT NULL THEN k END AS key_value,
       coalesce(r.cells, CASE "table" WHEN 'orders' THEN 'id,priority,status'
                                      WHEN 'customer' THEN 'id,name,segment'
                                      ELSE 'name,supplier_id' END) AS cells
FROM changes_ LEFT JOIN rules_ r
  ON t = "table" AND o = CASE WHEN type = 'read' THEN 'insert' ELSE type END
WHERE type <> 'delete'""",
    "dim_upsert": _LATEST,
    "dim_store": _LATEST,
    "load_new_and_changed": """
SELECT o_custkey AS id, max(o_orderkey) AS seq, arg_max(o_orderstatus, o_orderkey) AS status,
       arg_max(o_orderpriority, o_orderkey) AS priority
FROM orders GROUP BY o_custkey""",
    "load_incremental": """
SELECT event_id, ts, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup')""",
    "ads_rollup": f"""
SELECT l_returnflag, l_linestatus,
       CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS gid, {_SUMS}
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "ads_cube": f"""
SELECT l_returnflag, l_linestatus, l_linenumber,
       CAST(grouping(l_returnflag, l_linestatus, l_linenumber) AS BIGINT) AS gid, {_SUMS}
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "ads_totals": f"""
SELECT l_returnflag, l_linestatus,
       CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS gid, {_SUMS}
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), ())""",
    "ads_filter_agg": f"""
SELECT l_returnflag, {_SUMS} FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_returnflag""",
    "ads_visits": f"""
WITH {_PAGES}, {_UV}, {_UJ}, {_visitor(_DAY, '1 DAY')}
SELECT ch, ar, CAST(grouping(ch, ar) AS BIGINT) AS gid, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
       CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
       CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum
FROM visitor_ GROUP BY ROLLUP (ch, ar)""",
    "split_cast": """
SELECT user_id AS number FROM events UNION ALL SELECT event_id FROM events""",
    "side_output": """
SELECT CAST(event_id AS VARCHAR) AS event_id FROM events
UNION ALL SELECT 'sideout-' || CAST(event_id AS VARCHAR) FROM events""",
    "csv_parse": """
SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name, CAST(floor(epoch(ts)) AS BIGINT) AS ts
FROM events""",
    "text_time": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text,
       epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o_orderdate, '%H') AS create_hour, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(19 AS BIGINT) AS length,
       CAST(floor((DATE '2024-01-01' - CAST(o_orderdate AS DATE)) / 365.0) AS INTEGER) AS age
FROM orders""",
    "event_time_fallback": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 1 HOUR ELSE o_orderdate END
         AS event_ts
FROM orders WHERE o_orderstatus = 'F'""",
    "action_codec": "SELECT event_id, user_id, event_type AS action FROM events",
    "copy_fields": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice,
       epoch_ms(o_orderdate) AS o_orderdate, CAST(NULL AS VARCHAR) AS absent
FROM orders""",
    "json_lines": """
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '"' ||
       CASE WHEN event_type = 'purchase' THEN ',"buyer":' || user_id ELSE '' END || '}' AS value
FROM events""",
    "camel_columns": """
SELECT o_orderkey AS "orderKeyId", o_custkey AS "oCustkey", o_orderstatus AS "oOrderstatus",
       o_totalprice AS "oTotalprice", o_orderdate AS "oOrderdate",
       o_orderpriority AS "oOrderpriority"
FROM orders""",
    "counter": "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS value, c_custkey FROM customer",
    "order_table": """
SELECT CAST(o_orderkey AS VARCHAR) AS "transactionId", o_orderdate AS "orderTime",
       CAST(NULL AS TIMESTAMP) AS "promiseTime"
FROM orders""",
    "csv_sink": "SELECT p_partkey, p_name, p_brand, p_size FROM part",
    "routed_sink": f"SELECT * FROM ({_TOPIC_COUNTS}) WHERE n > 0",
}

# Stream twins give what the batch forms give.
ORACLE.update(
    {
        f"stream_{name}": ORACLE[name]
        for name in (
            "interval_join_orders", "interval_join_payment", "order_wide", "payment_wide",
            "new_visitor_fix", "user_jump", "session_count", "running_total", "running_count",
            "key_counts", "visitor_stats", "product_stats", "dim_upsert",
        )
    }
)
ORACLE["stream_user_jump_timed"] = ORACLE["user_jump"]
ORACLE["stream_base_log"] = ORACLE["base_log_messages"]
_VISITS = ", ".join(
    f"CAST(sum({m}) AS BIGINT) AS {m}" for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
)
_VISITOR = f"WITH {_PAGES}, {_UV}, {_UJ}, {_visitor(_DAY, '1 DAY')}"
ORACLE["ads_visits_cube"] = f"""
{_VISITOR} SELECT ch, ar, is_new, CAST(grouping(ch, ar, is_new) AS BIGINT) AS gid, {_VISITS}
FROM visitor_ GROUP BY CUBE (ch, ar, is_new)"""
ORACLE["ads_visits_total"] = f"""
{_VISITOR} SELECT ch, ar, CAST(grouping(ch, ar) AS BIGINT) AS gid, {_VISITS}
FROM visitor_ GROUP BY GROUPING SETS ((ch, ar), ())"""
ORACLE["ads_visits_new"] = f"""
{_VISITOR} SELECT vc, ch, {_VISITS} FROM visitor_ WHERE is_new = '1' GROUP BY vc, ch"""
ORACLE["stream_buffered_sink"] = "SELECT event_id, user_id, event_type FROM events"
ORACLE["stream_unique_visit"] = ORACLE["unique_visit"]
ORACLE["stream_committed_sink"] = ORACLE["stream_buffered_sink"]
ORACLE["stream_buffered_exact"] = """
SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY event_id // 500) AS file_rows
FROM events"""
ORACLE["stream_base_db"] = f"""
WITH {_CHANGES}
SELECT CASE WHEN type = 'update' THEN 'olap_orders' ELSE 'dwd_order_info' END AS topic,
       count(*) AS n, count(*) AS cells
FROM changes_ WHERE "table" = 'orders' AND type <> 'delete' GROUP BY 1
UNION ALL
SELECT 'dwd_unmatched', count(*), 0 FROM changes_ WHERE "table" = 'supplier' AND type = 'update'
HAVING count(*) > 0
UNION ALL
SELECT 'dim_user', count(*), count(segment)
FROM changes_ WHERE "table" = 'customer' AND type <> 'delete'"""

# The table's rows lie in the order of their ids.
ORACLE["stream_counter_source"] = """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS value, event_id, user_id, event_type
FROM events"""
ORACLE["stream_topic_offsets"] = """
SELECT 'odd_events' AS topic, event_id,
  row_number() OVER (ORDER BY event_id % 5, event_id) AS place
FROM events WHERE user_id % 2 = 1
UNION ALL
SELECT 'even_events', event_id, row_number() OVER (ORDER BY event_id % 5, event_id)
FROM events WHERE user_id % 2 = 0"""
ORACLE["stream_late_rows"] = """
WITH arrived AS (
  SELECT event_id, props,
    event_id // (((SELECT count(*) FROM events) + 4) // 5) AS batch,
    CASE WHEN event_id % 10 = 3 THEN ts - INTERVAL 3 DAY ELSE ts END AS t FROM events),
latest AS (SELECT batch, max(t) AS m FROM arrived GROUP BY batch),
marks AS (
  SELECT batch, max(m) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 1 HOUR AS mark FROM latest),
judged AS (
  SELECT a.*, strftime(t, '%Y-%m-%d') AS day,
    coalesce(date_trunc('day', t) + INTERVAL 1 DAY <= mark, false) AS late
  FROM arrived a JOIN marks USING (batch))
SELECT 'late' AS kind, day, event_id, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS size
FROM judged WHERE late
UNION ALL
SELECT 'on time', day, NULL, count(*), CAST(sum(length(props)) AS BIGINT)
FROM judged WHERE NOT late GROUP BY day"""
ORACLE["stream_lookup_pruned"] = """
SELECT event_id, user_id, c_name AS name,
  CASE WHEN c_custkey % 5 <= event_id // (((SELECT count(*) FROM events) + 4) // 5)
    THEN 'changed ' || CAST(c_custkey % 5 AS VARCHAR) ELSE c_mktsegment END AS segment
FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase'"""
ORACLE["stream_cdc_handover"] = """
WITH log AS (
  SELECT o_custkey AS id, o_orderkey AS pos, o_orderkey % 13 = 0 AS gone,
    o_orderstatus AS status, o_orderpriority AS priority,
    strftime(o_orderdate, '%Y-%m-%d') AS last_day,
    (SELECT max(o_orderkey) FROM orders) AS t, o_custkey % 4 AS chunk FROM orders),
marked AS (
  SELECT *, t * (2 * chunk + 1) // 9 AS low, t * (2 * chunk + 2) // 9 AS high FROM log),
counted AS (
  SELECT id, count(*) FILTER (pos > low) AS n_changes,
    count(*) FILTER (pos > low AND pos <= high) AS inside,
    arg_max(gone, pos) FILTER (pos <= low + t // 18) AS seen_gone
  FROM marked GROUP BY id),
last_ AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1)
SELECT id, status, priority, last_day, n_changes,
  CAST(CASE WHEN seen_gone = false AND inside = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_reads
FROM last_ JOIN counted USING (id) WHERE NOT gone"""

_LINE = """
  SELECT event_id, event_type, CASE WHEN event_type = 'signup' AND row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 THEN '1' ELSE '0' END AS is_new,
    user_id, (epoch_us(ts) // 1000) AS ms
  FROM events"""
ORACLE["log_messages_page"] = f"""
SELECT event_id, '{{"event_id":' || event_id || ',"common":{{"ext":{{"q":' || (user_id % 7)
  || '}},"is_new":"' || is_new || '","mid":"' || user_id || '"}},"displays":[{{'
  || CASE WHEN event_type = 'signup' AND is_new = '0'
       THEN '"from":{{"page_id":"inner"}},"item":"' || event_id || '","page_id":"old"}}'
       ELSE '"item":"' || event_id || '","from":{{"page_id":"inner"}},"page_id":"old"}}' END
  || ',{{"note":[{{"b":1}},null]}}],"page":{{"page_id":"' || event_type || '"}},"sid":"s{{'
  || event_id || '}}","ts":' || ms || '}}' AS value
FROM ({_LINE})"""
ORACLE["log_messages_display"] = """
SELECT event_id, '{"from":{"page_id":"inner"},"item":"' || event_id || '","page_id":"'
  || event_type || '"}' AS value FROM events"""
ORACLE["unreadable_changes"] = """
SELECT c_custkey AS seq, 'customer' AS "table",
  CASE WHEN c_custkey % 7 <> 0 THEN ['insert', 'update', 'delete', 'read'][c_custkey % 4 + 1]
    END AS type,
  CASE WHEN c_custkey % 7 = 0 THEN 'cut ' || c_custkey || ' {' END AS text
FROM customer"""
ORACLE["stream_rescaled"] = ORACLE["running_total"]
