"""Record layouts. Field names are the wire names of the input and output topics."""

from __future__ import annotations

# Behaviour log. Numbers and flags are read as text first, so that quoted and unquoted
# forms are both accepted; exposures and start objects stay open.
LOG_CORE = """
    common STRUCT<mid: STRING, is_new: STRING>,
    page STRUCT<page_id: STRING, last_page_id: STRING>,
    ts STRING
"""
LOG_OPEN = "start MAP<STRING, VARIANT>, display ARRAY<MAP<STRING, VARIANT>>"

# Any JSON object, with every value kept in its own JSON type.
OPEN_RECORD = "MAP<STRING, VARIANT>"

MONEY = "DECIMAL(16,2)"

ORDER_INFO = f"""
    id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT,
    total_amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY},
    original_total_amount {MONEY}, feight_fee {MONEY},
    expire_time STRING, create_time STRING, operate_time STRING,
    create_date STRING, create_hour STRING, create_ts BIGINT
"""

ORDER_DETAIL = f"""
    id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, sku_num BIGINT,
    sku_name STRING, create_time STRING, create_ts BIGINT,
    split_total_amount {MONEY}, split_activity_amount {MONEY}, split_coupon_amount {MONEY}
"""

ROUTE_CONFIG = """
    source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING,
    sink_columns STRING, sink_pk STRING, sink_extend STRING
"""

# Wide order record: (column, type), in output order.
WIDE_FACT_COLUMNS = [
    ("detail_id", "BIGINT"), ("order_id", "BIGINT"), ("sku_id", "BIGINT"),
    ("order_price", MONEY), ("sku_num", "BIGINT"), ("sku_name", "STRING"),
    ("province_id", "BIGINT"), ("order_status", "STRING"), ("user_id", "BIGINT"),
    ("total_amount", MONEY), ("activity_reduce_amount", MONEY),
    ("coupon_reduce_amount", MONEY), ("original_total_amount", MONEY),
    ("feight_fee", MONEY), ("split_feight_fee", MONEY), ("split_activity_amount", MONEY),
    ("split_coupon_amount", MONEY), ("split_total_amount", MONEY),
    ("expire_time", "STRING"), ("create_time", "STRING"), ("operate_time", "STRING"),
    ("create_date", "STRING"), ("create_hour", "STRING"),
]

# Topic names shared with the producers and consumers around these jobs.
TOPIC_RAW_LOG = "ODS_BASE_LOG"
TOPIC_RAW_DB = "ODS_BASE_DB_M"
TOPIC_START = "DWD_START_LOG"
TOPIC_PAGE = "DWD_PAGE_LOG"
TOPIC_DISPLAY = "DWD_DISPLAY_LOG"
TOPIC_ORDER_INFO = "DWD_ORDER_INFO"
TOPIC_ORDER_DETAIL = "DWD_ORDER_DETAIL"
TOPIC_UNIQUE_VISIT = "DWM_UNIQUE_VISIT"
TOPIC_USER_JUMP = "DWM_USER_JUMP_DETAIL"
TOPIC_ORDER_WIDE = "DWM_ORDER_WIDE"

TOPIC_DEFAULT = "DEFAULT_DATA"  # routed records without a destination of their own

# Words of the change records and of the routing configuration.
SINK_DIMENSION = "HBASE"
SINK_FACT = "KAFKA"
SNAPSHOT_INSERT = "bootstrap-insert"
DEFAULT_KEY = "id"

# Bounds and thresholds the jobs start from; all are parameters.
BOUNCE_MS = 10_000
JOIN_BOUND_MS = 5_000
MIN_COLUMNS = 4
