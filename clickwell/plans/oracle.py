"""Independent SQL for the queries, written on the base tables and run by another engine."""

from __future__ import annotations

import textwrap

HOUR = 3_600_000
MONTH = 30 * 24 * HOUR

PAGE_LOG = """
    ev AS (
        SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, event_type AS page_id,
               epoch_us(ts) // 1000 AS ts, CASE WHEN value >= 50 THEN '1' ELSE '0' END AS is_new,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events
    ),
    page_log AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w < 7200000 THEN lag(page_id) OVER w END AS last_page_id,
               strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS visit_day
        FROM ev WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
    ),
    entries AS (SELECT * FROM page_log WHERE coalesce(last_page_id, '') = ''),
    valid_log AS (SELECT * FROM page_log WHERE k >= 4),
    followed AS (
        SELECT *, lead(ts) OVER w - ts AS next_gap, ts - lag(ts) OVER w AS prev_gap,
               lag(coalesce(last_page_id, '') = '') OVER w AS prev_is_entry
        FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
    )
"""

CHANGES = """
    raw_changes AS (
        SELECT 'customer' AS "table", c_custkey AS id, c_custkey % 3 AS m, 4 AS width, 0 AS size,
               {'id': CAST(c_custkey AS VARCHAR), 'name': c_name, 'nation_id': CAST(c_nationkey AS VARCHAR),
                'segment': c_mktsegment} AS c, NULL AS p, NULL AS o
        FROM customer
        UNION ALL
        SELECT 'part', p_partkey, p_partkey % 3, 5, p_size, NULL,
               {'id': CAST(p_partkey AS VARCHAR), 'name': p_name, 'brand': p_brand, 'type': p_type,
                'size': CAST(p_size AS VARCHAR)}, NULL
        FROM part
        UNION ALL
        SELECT 'orders', o_orderkey, o_orderkey % 3, 5, 0, NULL, NULL,
               {'id': CAST(o_orderkey AS VARCHAR), 'user_id': CAST(o_custkey AS VARCHAR),
                'order_status': o_orderstatus, 'priority': o_orderpriority,
                'create_time': strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')}
        FROM orders
        UNION ALL
        SELECT 'supplier', s_suppkey, s_suppkey % 3, 4, 0, NULL, NULL, NULL FROM supplier
        UNION ALL
        SELECT 'nation', n_nationkey, n_nationkey % 3, 3, 0, NULL, NULL, NULL FROM nation
    ),
    valid_changes AS (
        SELECT "table", id, width, c, p, o,
               CASE m WHEN 0 THEN 'bootstrap-insert' WHEN 1 THEN 'insert' ELSE 'update' END AS "type",
               CASE m WHEN 2 THEN 'update' ELSE 'insert' END AS kind
        FROM raw_changes WHERE width > 3 AND size NOT IN (1, 2, 3)
    ),
    config ("table", kind, target, sink_table) AS (VALUES
        ('customer', 'insert', 'dim', 'dim_customer'), ('customer', 'update', 'dim', 'dim_customer'),
        ('part', 'insert', 'dim', 'dim_part'), ('orders', 'insert', 'fact', 'dwd_order'),
        ('orders', 'update', 'fact', 'dwd_order_update'), ('supplier', 'insert', 'unsupported_sink', NULL)
    ),
    classified AS (
        SELECT v.*, coalesce(r.target, 'no_config') AS target, r.sink_table
        FROM valid_changes v LEFT JOIN config r USING ("table", kind)
    ),
    cells AS (
        SELECT "table", sink_table, target, id, e.key AS column_name, e.value AS column_value
        FROM (
            SELECT *, CASE
                WHEN "table" = 'customer' AND kind = 'insert' THEN [
                    {'key': 'id', 'value': c.id}, {'key': 'name', 'value': c.name},
                    {'key': 'segment', 'value': c.segment}]
                WHEN "table" = 'customer' THEN [
                    {'key': 'id', 'value': c.id}, {'key': 'segment', 'value': c.segment}]
                WHEN "table" = 'part' THEN [{'key': 'id', 'value': p.id}, {'key': 'name', 'value': p.name}]
                WHEN kind = 'insert' THEN [
                    {'key': 'id', 'value': o.id}, {'key': 'user_id', 'value': o.user_id},
                    {'key': 'order_status', 'value': o.order_status}]
                ELSE [
                    {'key': 'id', 'value': o.id}, {'key': 'user_id', 'value': o.user_id},
                    {'key': 'order_status', 'value': o.order_status},
                    {'key': 'priority', 'value': o.priority}, {'key': 'create_time', 'value': o.create_time}]
                END AS kept
            FROM classified WHERE target IN ('fact', 'dim')
        ), unnest(kept) AS u(e)
    )
"""

ORDERS = f"""
    info AS (
        SELECT o_orderkey AS order_id, CAST(c_nationkey AS BIGINT) AS province_id, o_orderstatus AS order_status,
               o_custkey AS user_id, o_totalprice AS total_amount, o_orderdate AS created,
               epoch_ms(o_orderdate) AS header_ts
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    ),
    detail AS (
        SELECT l_orderkey * 10 + l_linenumber AS detail_id, l_orderkey, l_partkey AS sku_id,
               l_extendedprice AS amount, CAST(l_quantity AS BIGINT) AS sku_num, l_discount, l_tax,
               l_shipdate AS created, epoch_ms(l_shipdate) AS line_ts
        FROM lineitem
    ),
    pairs AS (
        SELECT info.*, detail_id, sku_id, amount, sku_num, l_discount, l_tax, line_ts
        FROM info JOIN detail ON order_id = l_orderkey
    ),
    wide AS (SELECT * FROM pairs WHERE line_ts - header_ts BETWEEN -{MONTH} AND {MONTH})
"""

USER_CHANGES = """
    changes AS (
        SELECT CAST(user_id AS VARCHAR) AS id, ts, event_id AS seq, event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events
    ),
    page AS (
        SELECT id, event_type AS v FROM changes
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1
    ),
    buyer AS (
        SELECT id, CASE WHEN k >= 10 THEN 'buyer-' || k END AS v FROM changes WHERE event_type = 'purchase'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1
    ),
    viewed AS (
        SELECT id, CAST(k AS VARCHAR) AS v FROM changes WHERE event_type = 'view'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1
    ),
    before AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment FROM customer),
    ids AS (SELECT id FROM before UNION SELECT id FROM changes)
"""


def _sql(ctes: str, select: str) -> str:
    return f"WITH {textwrap.dedent(ctes).strip()}\n{textwrap.dedent(select).strip()}"


FLAG_REPAIR = _sql(PAGE_LOG, """
    SELECT seq, mid, ts, CASE WHEN is_new = '1' AND visit_day >
               min(CASE WHEN is_new = '1' THEN visit_day END) OVER (PARTITION BY mid)
           THEN '0' ELSE is_new END AS is_new
    FROM page_log
""")

UNIQUE_VISIT = _sql(PAGE_LOG, """
    SELECT seq, mid, page_id, ts, visit_day FROM entries
    QUALIFY row_number() OVER (PARTITION BY mid, visit_day ORDER BY ts, seq) = 1
""")

JUMP_DETAIL = _sql(PAGE_LOG, f"""
    SELECT seq, mid, page_id, ts FROM followed
    WHERE coalesce(last_page_id, '') = '' AND (next_gap IS NULL OR next_gap >= {HOUR})
""")

JUMP_IN_TIME = _sql(PAGE_LOG, f"""
    SELECT seq, mid, page_id, ts FROM followed
    WHERE page_id <> '' AND prev_is_entry AND prev_gap < {HOUR}
""")


def _pairs(where: str, header: str = "header_ts", line: str = "line_ts") -> str:
    return _sql(ORDERS, f"""
        SELECT order_id, detail_id, sku_id, {header} AS header_ts, {line} AS line_ts FROM pairs WHERE {where}
    """)


INTERVAL_JOIN = _pairs(f"line_ts - header_ts BETWEEN -{MONTH} AND {MONTH}")


def _stats(select: str, join: str = "") -> str:
    return _sql(ORDERS, f"""
        SELECT {select}, count(*) AS order_lines, CAST(sum(sku_num) AS BIGINT) AS pieces,
               CAST(sum(CAST(amount AS DECIMAL(16,2))) AS DOUBLE) AS amount
        FROM wide {join} GROUP BY 1
    """)


ORACLE: dict[str, str] = {
    "log_parse_valid": _sql(PAGE_LOG, """
        SELECT seq, mid, is_new, CASE WHEN page_id <> 'signup' THEN page_id END AS page_id,
               CASE WHEN page_id <> 'signup' THEN last_page_id END AS last_page_id, ts
        FROM valid_log
    """),
    "log_rejects": _sql(PAGE_LOG, """
        SELECT seq, CASE WHEN k < 2 THEN 'malformed' ELSE 'incomplete' END AS reason
        FROM page_log WHERE k < 4
    """),
    "log_dates": _sql(PAGE_LOG, """
        SELECT seq, ts, strftime(make_timestamp(ts * 1000), '%Y%m%d') AS day_compact,
               strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day_dashed
        FROM page_log
    """),
    "log_start": _sql(PAGE_LOG, "SELECT seq, mid, 'icon' AS entry FROM valid_log WHERE page_id = 'signup'"),
    "log_page": _sql(PAGE_LOG, """
        SELECT seq, mid, page_id, last_page_id FROM valid_log WHERE page_id <> 'signup'
    """),
    "log_display_explode": _sql(PAGE_LOG, """
        SELECT seq, mid, CAST(pos AS BIGINT) AS pos, shown AS page_id, 'item-' || k AS item, shown AS item_page_id
        FROM (
            SELECT *, CASE WHEN pos = 1 THEN 'promo' ELSE page_id END AS shown
            FROM valid_log, range(2) AS r(pos)
            WHERE page_id = 'view' AND pos < k % 3
        )
    """),
    "visitor_flag_repair": FLAG_REPAIR,
    "entry_pages": _sql(PAGE_LOG, "SELECT seq, mid, page_id, ts FROM entries"),
    "unique_visit": UNIQUE_VISIT,
    "jump_detail": JUMP_DETAIL,
    "jump_in_time": JUMP_IN_TIME,
    "daily_uv": _sql(PAGE_LOG, """
        SELECT visit_day, count(DISTINCT mid) AS uv FROM entries GROUP BY visit_day
    """),
    "bounce_rate": _sql(PAGE_LOG, f"""
        SELECT visit_day, count(*) AS visits,
               count(*) FILTER (next_gap IS NULL OR next_gap >= {HOUR}) AS bounces,
               round(count(*) FILTER (next_gap IS NULL OR next_gap >= {HOUR}) / count(*), 6) AS bounce_rate
        FROM followed WHERE coalesce(last_page_id, '') = '' GROUP BY visit_day
    """),
    "cdc_valid": _sql(CHANGES, """
        SELECT "table", "type", id, CAST(width AS BIGINT) AS width FROM valid_changes
    """),
    "cdc_rejects": _sql(CHANGES, """
        SELECT CASE size WHEN 1 THEN 'no_data' WHEN 2 THEN 'no_table' WHEN 3 THEN 'malformed'
                         ELSE 'too_narrow' END AS reason, count(*) AS n
        FROM raw_changes WHERE width <= 3 OR size IN (1, 2, 3) GROUP BY 1
    """),
    "cdc_normalize": _sql(CHANGES, """
        SELECT "table", kind AS "type", count(*) AS n FROM valid_changes GROUP BY ALL
    """),
    "cdc_route": _sql(CHANGES, """
        SELECT "table", kind AS "type", id, target, sink_table FROM classified WHERE target IN ('fact', 'dim')
    """),
    "cdc_unrouted": _sql(CHANGES, """
        SELECT "table", kind AS "type", id, target AS reason FROM classified WHERE target NOT IN ('fact', 'dim')
    """),
    "cdc_project": _sql(CHANGES, 'SELECT "table", sink_table, id, column_name, column_value FROM cells'),
    "cdc_facts": _sql(CHANGES, """
        SELECT "table", sink_table, id, column_name, column_value FROM cells WHERE target = 'fact'
    """),
    "cdc_dims": _sql(CHANGES, """
        SELECT "table", sink_table, id, column_name, column_value FROM cells WHERE target = 'dim'
    """),
    "dim_upsert": _sql(USER_CHANGES, """
        SELECT ids.id, CASE WHEN buyer.id IS NULL THEN segment ELSE buyer.v END AS segment,
               page.v AS last_page,
               CASE WHEN viewed.id IS NOT NULL THEN viewed.v WHEN before.id IS NOT NULL THEN 'never' END AS last_view
        FROM ids LEFT JOIN before USING (id) LEFT JOIN page USING (id)
        LEFT JOIN buyer USING (id) LEFT JOIN viewed USING (id)
    """),
    "order_event_time": """
        SELECT l_orderkey * 10 + l_linenumber AS id, epoch_ms(date_trunc('second', l_shipdate)) AS exact_ts,
               epoch_ms(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS day_ts
        FROM lineitem
    """,
    "order_interval_join": INTERVAL_JOIN,
    "order_interval_join_5s": _pairs("line_ts - header_ts BETWEEN -5000 AND 5000"),
    "order_same_day_join": _pairs(
        "line_ts // 86400000 = header_ts // 86400000",
        "header_ts // 86400000 * 86400000", "line_ts // 86400000 * 86400000",
    ),
    "order_wide": _sql(ORDERS, """
        SELECT detail_id, order_id, sku_id, amount AS order_price, sku_num, 'sku-' || sku_id AS sku_name,
               province_id, order_status, user_id, total_amount,
               CAST(NULL AS DOUBLE) AS activity_reduce_amount, CAST(NULL AS DOUBLE) AS coupon_reduce_amount,
               CAST(NULL AS DOUBLE) AS original_total_amount, CAST(NULL AS DOUBLE) AS feight_fee,
               CAST(NULL AS DOUBLE) AS split_feight_fee, l_discount AS split_activity_amount,
               l_tax AS split_coupon_amount, amount AS split_total_amount,
               CAST(NULL AS VARCHAR) AS expire_time, strftime(created, '%Y-%m-%d %H:%M:%S') AS create_time,
               CAST(NULL AS VARCHAR) AS operate_time, strftime(created, '%Y-%m-%d') AS create_date,
               strftime(created, '%H') AS create_hour
        FROM wide
    """),
    "order_wide_merge": _sql(ORDERS, """
        SELECT order_id, coalesce(a.order_status, b.order_status) AS order_status,
               coalesce(a.user_id, b.user_id) AS user_id,
               coalesce(a.total_amount, b.total_amount) AS total_amount,
               coalesce(a.create_date, b.create_date) AS create_date
        FROM (SELECT order_id, order_status, user_id, CASE WHEN total_amount < 200000 THEN total_amount END
                     AS total_amount, strftime(created, '%Y-%m-%d') AS create_date
              FROM info WHERE order_status <> 'F') a
        FULL JOIN
             (SELECT order_id, order_status, user_id, total_amount,
                     CASE WHEN order_status = 'O' THEN strftime(created, '%Y-%m-%d') END AS create_date
              FROM info WHERE total_amount >= 100000) b
        USING (order_id)
    """),
    "order_wide_dims": _sql(ORDERS, """
        SELECT detail_id, order_id, sku_id, user_id, province_id, amount AS split_total_amount,
               n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
               r_name AS province_iso_code, 'X-' || n_nationkey AS province_3166_2_code,
               c_custkey % 60 + 18 AS user_age, substr(c_mktsegment, 1, 1) AS user_gender,
               CAST(p_size AS BIGINT) AS spu_id, CAST(substr(p_brand, 7) AS BIGINT) AS tm_id,
               CAST(length(p_type) * 100 + ascii(p_type) AS BIGINT) AS category3_id,
               'size ' || p_size AS spu_name, p_brand AS tm_name, p_type AS category3_name
        FROM wide
        LEFT JOIN part ON sku_id = p_partkey LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON province_id = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """),
    "order_wide_dims_asof": _sql(ORDERS, """
        SELECT detail_id, order_id, user_id, province_id, header_ts, levels.v AS user_level, grades.v AS user_grade,
               codes.v AS province_code
        FROM wide
        ASOF LEFT JOIN (
            SELECT c_custkey AS id, 0 AS ts, 'none' AS v FROM customer
            UNION ALL
            SELECT o_custkey, epoch_ms(o_orderdate) + 86400000, arg_max(o_orderpriority, o_orderkey) FROM orders GROUP BY ALL
        ) levels ON levels.id = user_id AND header_ts >= levels.ts
        ASOF LEFT JOIN (
            SELECT c_custkey AS id, 0 AS ts, c_mktsegment AS v FROM customer
            UNION ALL
            SELECT o_custkey, epoch_ms(o_orderdate) + 86400000,
                   arg_max({'v': CASE o_orderstatus WHEN 'P' THEN 'P' || o_orderkey END}, o_orderkey).v
            FROM orders WHERE o_orderstatus <> 'O' GROUP BY o_custkey, o_orderdate
        ) grades ON grades.id = user_id AND header_ts >= grades.ts
        ASOF LEFT JOIN (
            SELECT CAST(c_nationkey AS BIGINT) AS id, epoch_ms(o_orderdate) + 86400000 AS ts, 'X-' || max(o_orderkey) AS v
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, o_orderdate
        ) codes ON codes.id = province_id AND header_ts >= codes.ts
    """),
    "order_wide_merge_all": """
        SELECT o_orderkey AS order_id, o_orderstatus AS order_status, o_custkey AS user_id,
               o_totalprice AS total_amount, strftime(o_orderdate, '%Y-%m-%d') AS create_date
        FROM orders
    """,
    "order_stats_by_area": _stats(
        "CAST(n_regionkey AS VARCHAR) AS province_area_code", "LEFT JOIN nation ON province_id = n_nationkey"
    ),
    "order_stats_by_user": _stats("user_id"),
    "order_stats_by_product": _stats("sku_id"),
    "order_stats_by_category": _stats("p_type AS category3_name", "LEFT JOIN part ON sku_id = p_partkey"),
    "order_stats_by_brand": _stats("p_brand AS tm_name", "LEFT JOIN part ON sku_id = p_partkey"),
}

# Streaming jobs have to give what the batch operators give.
_VALID_DAYS = """
    SELECT *, CASE WHEN is_new = '1' AND visit_day >
                   min(CASE WHEN is_new = '1' THEN visit_day END) OVER (PARTITION BY mid)
              THEN '0' ELSE is_new END AS flag
    FROM valid_log
"""

ORACLE |= {
    "stream_flag_repair": _sql(PAGE_LOG, f"SELECT mid, ts, flag AS is_new FROM ({_VALID_DAYS})"),
    "stream_log_split": _sql(PAGE_LOG, """
        SELECT 'start' AS kind, CAST(NULL AS VARCHAR) AS page_id, count(*) AS n
        FROM valid_log WHERE page_id = 'signup'
        UNION ALL
        SELECT 'page', page_id, count(*) FROM valid_log WHERE page_id <> 'signup' GROUP BY page_id
        UNION ALL
        SELECT 'display', CASE WHEN pos = 1 THEN 'promo' ELSE page_id END AS shown, count(*)
        FROM valid_log, range(2) AS r(pos) WHERE page_id = 'view' AND pos < k % 3 GROUP BY shown
    """),
    "stream_unique_visit": f"SELECT mid, page_id, ts, visit_day FROM ({UNIQUE_VISIT})",
    "stream_jump": f"SELECT mid, page_id, ts FROM ({JUMP_DETAIL})",
    "stream_jump_in_time": f"""
        SELECT 'bounce' AS kind, mid, page_id, ts FROM ({JUMP_DETAIL})
        UNION ALL
        SELECT 'in_time', mid, page_id, ts FROM ({JUMP_IN_TIME})
    """,
    "stream_interval_join": _sql(ORDERS, """
        SELECT order_id, detail_id, sku_id, strftime(created, '%Y-%m-%d %H:%M:%S') AS create_time FROM wide
    """),
    "stream_cdc_route": _sql(CHANGES, "SELECT sink_table, id, column_name, column_value FROM cells"),
    # Ranges are quarters of the span; every twentieth record comes one range late.
    "stream_unique_visit_late": _sql(PAGE_LOG, """
        SELECT kind, mid, page_id, ts FROM (
            WITH spans AS (SELECT min(ts) AS low, max(ts) AS high FROM page_log),
            landed AS (
                SELECT p.*, own + CASE WHEN seq % 20 = 7 AND own < 3 THEN 1 ELSE 0 END AS part
                FROM (SELECT *, ((ts - low) * 4) // (high - low + 1) AS own FROM page_log, spans) p
            ),
            marks AS (
                SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
                FROM landed GROUP BY part
            ),
            judged AS (SELECT l.*, ts <= coalesce(mark, 0) - 3600000 AS late FROM landed l JOIN marks USING (part))
            SELECT CASE WHEN late THEN 'late' ELSE 'on_time' END AS kind, mid, page_id, ts FROM judged
            UNION ALL
            SELECT 'visit', mid, arg_min(page_id, {'ts': ts, 'seq': seq}), min(ts)
            FROM judged WHERE NOT late AND coalesce(last_page_id, '') = '' GROUP BY mid, visit_day
        )
    """),
    "stream_collect": _sql(PAGE_LOG, """
        SELECT 'landing' AS place, visit_day AS dt, count(*) AS n FROM page_log GROUP BY visit_day
        UNION ALL
        SELECT 'topic', NULL, count(*) FROM page_log
    """),
    "stream_first_seen": f"SELECT mid, visit_day, 1 AS n FROM ({UNIQUE_VISIT})",
    "stream_order_wide_merge": ORACLE["order_wide_merge_all"],
    "stream_cdc_refresh": _sql(CHANGES, """
        SELECT CASE WHEN "table" = 'supplier' THEN 'dwd_supplier' WHEN id % 4 >= 2 THEN 'dwd_order_new'
               WHEN kind = 'insert' THEN 'dwd_order' ELSE 'dwd_order_update' END AS topic, id
        FROM valid_changes
        WHERE "table" = 'orders' AND (id % 4 < 2 OR kind = 'insert') OR "table" = 'supplier' AND kind = 'insert' AND id % 4 >= 2
    """),
    "stream_order_wide_dims": ORACLE["order_wide_dims"],
}
