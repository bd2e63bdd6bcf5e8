"""Inputs of the jobs, derived from the given test tables.

The tables hold no app log and no change stream; these views shape them into one. Everything
is computed from whole tables and grows with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.functions.cells import with_neighbours
from clickwell.operators.orders import order_event_time, sku_dimension
from clickwell.schemas import MONEY, ROUTE_CONFIG
from clickwell.sources.tables import local_rows, read_route_config, read_table

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
VISIT_GAP_MS = 2 * HOUR_MS
LOG_CELL_MS = 8 * HOUR_MS


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _time_text(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as page views: seq, mid, page_id, last_page_id, ts, is_new, k. The last page is
    the previous event of the visitor if that is less than two hours back."""
    views = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("mid"),
        F.col("event_type").alias("page_id"),
        _millis("ts").alias("ts"),
        F.when(F.col("value") >= 50, "1").otherwise("0").alias("is_new"),
        _k().alias("k"),
    )
    seen = with_neighbours(
        views, "mid", VISIT_GAP_MS, prev_fields={"page_id": F.col("page_id")}, cell=LOG_CELL_MS
    )
    return seen.withColumn("last_page_id", F.col("prev.page_id")).drop("prev")


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`page_log` as raw JSON lines (seq, value). Sign-ups are start records, views show k % 3
    exposures of which the second names its own page; k below 2 gives cut-off text, k of 2 and
    3 a record without `common`."""
    log = page_log(spark, sf_dir)
    start = F.when(
        F.col("page_id") == "signup", F.struct(F.lit("icon").alias("entry"), F.col("k").alias("loading"))
    )
    page = F.when(F.col("page_id") != "signup", F.struct("page_id", "last_page_id"))
    shown = F.when(F.col("page_id") == "view", F.col("k") % 3).otherwise(0)
    exposure = lambda order: F.struct(
        F.concat(F.lit("item-"), F.col("k").cast("string")).alias("item"),
        order.alias("order"),
        F.when(order == 1, F.struct(F.lit("promo").alias("page_id"))).alias("page"),
    )
    display = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), 1, shown), exposure)
    common = F.when(~F.col("k").isin(2, 3), F.struct("mid", "is_new"))
    text = F.to_json(F.struct(
        common.alias("common"), start.alias("start"), page.alias("page"),
        F.when(shown > 0, display).alias("display"), "ts",
    ))
    cut = F.expr("substr(value, 1, length(value) - 5)")
    lines = log.select("seq", "k", text.alias("value"))
    return lines.select("seq", F.when(F.col("k") < 2, cut).otherwise(F.col("value")).alias("value"))


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records (value) of five tables. The operation goes by key mod 3. Parts of size 1
    lack `data`, of size 2 `table`, of size 3 are cut off; nations have too few columns."""
    def changes(table: str, key: str, data: dict[str, Column]) -> DataFrame:
        kind = F.element_at(
            F.array(*[F.lit(k) for k in ("bootstrap-insert", "insert", "update")]),
            (F.col(key) % 3 + 1).cast("int"),
        )
        size = F.col("p_size") if table == "part" else F.lit(0)
        envelope = F.to_json(F.struct(
            F.when(size != 2, F.lit(table)).alias("table"),
            kind.alias("type"),
            F.col(key).cast("bigint").alias("ts"),
            F.when(size != 1, F.struct(*[item.alias(name) for name, item in data.items()])).alias("data"),
        ))
        rows = read_table(spark, sf_dir, table)
        cut = F.substring(envelope, 1, 20)
        return rows.select(F.when(size == 3, cut).otherwise(envelope).alias("value"))

    col = F.col
    parts = [
        changes("customer", "c_custkey", {
            "id": col("c_custkey"), "name": col("c_name"),
            "nation_id": col("c_nationkey"), "segment": col("c_mktsegment"),
        }),
        changes("part", "p_partkey", {
            "id": col("p_partkey"), "name": col("p_name"), "brand": col("p_brand"),
            "type": col("p_type"), "size": col("p_size"),
        }),
        changes("orders", "o_orderkey", {
            "id": col("o_orderkey"), "user_id": col("o_custkey"), "order_status": col("o_orderstatus"),
            "priority": col("o_orderpriority"), "create_time": _time_text("o_orderdate"),
        }),
        changes("supplier", "s_suppkey", {
            "id": col("s_suppkey"), "name": col("s_name"), "nation_id": col("s_nationkey"),
            "cents": F.round(col("s_acctbal") * 100).cast("bigint"),
        }),
        changes("nation", "n_nationkey", {
            "id": col("n_nationkey"), "name": col("n_name"), "region_id": col("n_regionkey"),
        }),
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


ROUTES = [
    # source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend
    ("customer", "insert", "HBASE", "dim_customer", "id,name", None, None),
    ("customer", "insert", "HBASE", "dim_customer", "id,name,segment", None, None),
    ("customer", "update", "HBASE", "dim_customer", "id,segment", "id", None),
    ("part", "insert", "hbase", "dim_part", "id,name, brand", "id", None),
    ("orders", "insert", "kafka", "dwd_order", "id,user_id,order_status", "id", None),
    ("orders", "update", "KAFKA", "dwd_order_update", None, "id", None),
    ("supplier", "insert", "CLICKHOUSE", "ck_supplier", "id", "id", None),
]


# What replaces them: new orders go to another topic, updated ones nowhere, suppliers are facts.
LATER_ROUTES = [
    *[route for route in ROUTES if route[0] in ("customer", "part")],
    ("orders", "insert", "kafka", "dwd_order_new", "id,order_status", "id", None),
    ("supplier", "insert", "kafka", "dwd_supplier", "id,name", "id", None),
]


def route_config(spark: SparkSession, routes: list[tuple] = ROUTES) -> DataFrame:
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    rows = [dict(zip(names, route), row_no=i) for i, route in enumerate(routes)]
    return read_route_config(local_rows(spark, rows, f"{ROUTE_CONFIG}, row_no BIGINT"))


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records (value) of the six dimensions of wide orders, one insert per row."""
    province, user, sku = dim_province(spark, sf_dir), dim_user(spark, sf_dir), dim_sku(spark, sf_dir)
    text = lambda name: F.lit(name)
    tables = {
        "base_province": province,
        "user_info": user.withColumn("name", F.concat(text("user-"), F.col("id").cast("string"))),
        "sku_info": sku.select(F.col("sku_id").alias("id"), "spu_id", "tm_id", "category3_id"),
        "spu_info": sku.select(F.col("spu_id").alias("id"), "spu_name", text("-").alias("description"), text("1").alias("sale")).distinct(),
        "base_trademark": sku.select(F.col("tm_id").alias("id"), "tm_name", text("-").alias("logo"), text("1").alias("sale")).distinct(),
        "base_category3": sku.select(
            F.col("category3_id").alias("id"), F.col("category3_name").alias("name"), text("1").alias("category2_id"), text("1").alias("sale")).distinct(),
    }
    changes = [
        rows.select(F.to_json(F.struct(
            F.lit(table).alias("table"), F.lit("insert").alias("type"), F.struct(*rows.columns).alias("data"))).alias("value"))
        for table, rows in tables.items()
    ]
    return reduce(DataFrame.unionAll, changes)


DIM_ROUTES = [
    # source_table, sink_columns; each to the dimension of its name
    ("base_province", "id,name,area_code,iso_code,iso_3166_2"),
    ("user_info", "id,age,gender"),
    ("sku_info", "id,spu_id,tm_id,category3_id"),
    ("spu_info", "id,spu_name"),
    ("base_trademark", "id,tm_name"),
    ("base_category3", "id,name"),
]


def dim_route_config(spark: SparkSession) -> DataFrame:
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    rows = [
        dict(zip(names, (table, "insert", "HBASE", f"dim_{table}", columns, "id", None)), row_no=i)
        for i, (table, columns) in enumerate(DIM_ROUTES)
    ]
    return read_route_config(local_rows(spark, rows, f"{ROUTE_CONFIG}, row_no BIGINT"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial changes (data, ts, seq) of a user dimension: every event sets `last_page`, a
    purchase also sets `segment` (to null when k is below 10), a view sets `last_view`."""
    kind, k = F.col("event_type"), _k()
    buyer = F.when(k >= 10, F.concat(F.lit("buyer-"), k.cast("string")))
    entries = F.map_concat(
        F.create_map(F.lit("id"), F.col("user_id").cast("string"), F.lit("last_page"), kind),
        F.when(kind == "purchase", F.create_map(F.lit("segment"), buyer)).otherwise(_no_entries()),
        F.when(kind == "view", F.create_map(F.lit("last_view"), k.cast("string"))).otherwise(_no_entries()),
    )
    return read_table(spark, sf_dir, "events").select(
        entries.alias("data"), _millis("ts").alias("ts"), F.col("event_id").alias("seq")
    )


def _no_entries() -> Column:
    return F.create_map().cast("map<string,string>")


def user_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension before the changes."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(None).cast("string").alias("last_page"),
        F.lit("never").alias("last_view"),
    )


def order_info(spark: SparkSession, sf_dir: str, precision: str = "exact") -> DataFrame:
    """`orders` as order headers; the province is the customer's nation."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        *[
            F.lit(None).cast(MONEY).alias(name)
            for name in ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee")
        ],
        F.lit(None).cast("string").alias("expire_time"),
        _time_text("o_orderdate").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        F.lit(None).cast("string").alias("create_date"),
        F.lit(None).cast("string").alias("create_hour"),
    )
    return order_event_time(rows, precision)


def partial_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order headers from two sources, all orders on both sides: the left one lacks large amounts and
    the users of pending orders, the right one small amounts and, of open orders, the day."""
    headers = order_info(spark, sf_dir).select(
        F.col("id").alias("order_id"), "order_status", "user_id", "total_amount",
        F.substring("create_time", 1, 10).alias("create_date"), "create_ts")
    amount, status = F.col("total_amount"), F.col("order_status")
    left = headers.withColumns({
        "total_amount": F.when(amount < 200_000, amount), "user_id": F.when(status != "P", F.col("user_id"))})
    right = headers.withColumns({
        "total_amount": F.when(amount >= 100_000, amount), "create_date": F.when(status != "O", F.col("create_date"))})
    return left, right


def order_detail(spark: SparkSession, sf_dir: str, precision: str = "exact") -> DataFrame:
    """`lineitem` as order lines. Line numbers repeat within an order, so `id` does too."""
    rows = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        _time_text("l_shipdate").alias("create_time"),
        F.col("l_extendedprice").cast(MONEY).alias("split_total_amount"),
        F.col("l_discount").cast(MONEY).alias("split_activity_amount"),
        F.col("l_tax").cast(MONEY).alias("split_coupon_amount"),
    )
    return order_event_time(rows, precision)


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.col("r_name").alias("iso_code"),
        F.concat(F.lit("X-"), F.col("n_nationkey").cast("string")).alias("iso_3166_2"),
    )


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
    )


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as SKUs: the size is the SPU, the brand the trademark, the type the category."""
    part = read_table(spark, sf_dir, "part")
    tm_id = F.expr("substr(p_brand, 7)").cast("bigint")
    category_id = (F.length("p_type") * 100 + F.ascii("p_type")).cast("bigint")
    sku = part.select(
        F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("spu_id"),
        tm_id.alias("tm_id"), category_id.alias("category3_id"),
    )
    spu = part.select(F.col("p_size").cast("bigint").alias("id")).distinct().withColumn(
        "spu_name", F.concat(F.lit("size "), F.col("id").cast("string"))
    )
    trademark = part.select(tm_id.alias("id"), F.col("p_brand").alias("tm_name")).distinct()
    category3 = part.select(category_id.alias("id"), F.col("p_type").alias("name")).distinct()
    return sku_dimension(sku, spu, trademark, category3)


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes (id, ts, seq, data) of users over the years: a day after each order the level is that
    order's priority; a pending or finished order sets the grade, a finished one to null."""
    first = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit(0).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        F.create_map(F.lit("level"), F.lit("none"), F.lit("grade"), F.col("c_mktsegment")).alias("data"))
    status = F.col("o_orderstatus")
    grade = F.create_map(F.lit("grade"), F.when(status == "P", F.concat(F.lit("P"), F.col("o_orderkey").cast("string"))))
    later = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), (_millis("o_orderdate") + DAY_MS).alias("ts"), F.col("o_orderkey").alias("seq"),
        F.map_concat(F.create_map(F.lit("level"), F.col("o_orderpriority")), F.when(status != "O", grade).otherwise(_no_entries())))
    return first.unionAll(later)


def province_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes (id, ts, seq, data) of provinces: every order of one renames its code. Few keys, so each
    has very many changes."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_nationkey").cast("bigint").alias("id"), (_millis("o_orderdate") + DAY_MS).alias("ts"),
        F.col("o_orderkey").alias("seq"), F.create_map(F.lit("code"), F.concat(F.lit("X-"), F.col("o_orderkey").cast("string"))).alias("data"))
