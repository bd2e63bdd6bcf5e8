"""Every operator as a runnable query over the test tables: name -> (spark, sf_dir) -> rows.

Results hold only whole numbers (bigint), doubles and text, so that two engines can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickwell import schemas
from clickwell.operators import asof, cdc, dims, logs, metrics, orders, visits
from clickwell.plans import adapters
from clickwell.session import finely_cut, tune

Query = Callable[[SparkSession, str], DataFrame]

# Events of one visitor in the test data are hours apart, so bounces are looked for within
# an hour instead of ten seconds.
BOUNCE_MS = adapters.HOUR_MS
# Header and line times in the test data are unrelated dates.
JOIN_MS = 30 * 24 * adapters.HOUR_MS

QUERIES: dict[str, Query] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Decimals to double, small integers to bigint."""
    def convert(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)
    return rows.select(*[convert(field) for field in rows.schema.fields])


def query(build: Query) -> Query:
    """Register a query under its function name. The test tables are in UTC."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(build(tune(spark), sf_dir.rstrip("/")))

    QUERIES[build.__name__] = run
    return run


# Behaviour log ---------------------------------------------------------------------------

def _parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_log(adapters.app_log(spark, sf_dir))


def _valid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.log_valid(_parsed_log(spark, sf_dir))


@query
def log_parse_valid(spark, sf_dir):
    return _valid_log(spark, sf_dir).select("seq", "mid", "is_new", "page_id", "last_page_id", "ts")


@query
def log_rejects(spark, sf_dir):
    return logs.log_rejects(_parsed_log(spark, sf_dir)).select("seq", "reason")


@query
def log_dates(spark, sf_dir):
    log = adapters.page_log(spark, sf_dir)
    return logs.log_dates(log).select("seq", "ts", "day_compact", "day_dashed")


@query
def log_start(spark, sf_dir):
    rows = logs.start_records(_valid_log(spark, sf_dir))
    return rows.select("seq", "mid", F.try_variant_get(F.col("start")["entry"], "$", "string").alias("entry"))


@query
def log_page(spark, sf_dir):
    return logs.page_records(_valid_log(spark, sf_dir)).select("seq", "mid", "page_id", "last_page_id")


@query
def log_display_explode(spark, sf_dir):
    item = F.to_json("item")
    return logs.display_records(_valid_log(spark, sf_dir)).select(
        "seq", "mid", "pos", "page_id",
        F.get_json_object(item, "$.item").alias("item"),
        F.get_json_object(item, "$.page_id").alias("item_page_id"),
    )


@query
def visitor_flag_repair(spark, sf_dir):
    log = adapters.page_log(spark, sf_dir).select("seq", "mid", "ts", "is_new")
    return logs.visitor_flag_repair(log)


# Visits ----------------------------------------------------------------------------------

@query
def entry_pages(spark, sf_dir):
    return visits.entry_pages(adapters.page_log(spark, sf_dir)).select("seq", "mid", "page_id", "ts")


@query
def unique_visit(spark, sf_dir):
    log = adapters.page_log(spark, sf_dir)
    return visits.unique_visit(log).select("seq", "mid", "page_id", "ts", "visit_day")


@query
def jump_detail(spark, sf_dir):
    log = adapters.page_log(spark, sf_dir)
    return visits.jump_detail(log, BOUNCE_MS).select("seq", "mid", "page_id", "ts")


@query
def jump_in_time(spark, sf_dir):
    log = adapters.page_log(spark, sf_dir)
    return visits.jump_in_time(log, BOUNCE_MS).select("seq", "mid", "page_id", "ts")


@query
def daily_uv(spark, sf_dir):
    return metrics.daily_uv(adapters.page_log(spark, sf_dir))


@query
def bounce_rate(spark, sf_dir):
    rate = metrics.bounce_rate(adapters.page_log(spark, sf_dir), BOUNCE_MS)
    return rate.withColumn("bounce_rate", F.round("bounce_rate", 6))


# Change records --------------------------------------------------------------------------

def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.parse_cdc(adapters.cdc_log(spark, sf_dir))


def _valid_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.cdc_normalize(cdc.cdc_valid(_changes(spark, sf_dir)))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = cdc.route_table(adapters.route_config(spark))
    return cdc.cdc_route(_valid_changes(spark, sf_dir), routes)


def _id():
    return F.try_variant_get(F.col("data")["id"], "$", "bigint").alias("id")


@query
def cdc_valid(spark, sf_dir):
    rows = cdc.cdc_valid(_changes(spark, sf_dir))
    return rows.select("table", "type", _id(), F.size("data").alias("width"))


@query
def cdc_rejects(spark, sf_dir):
    rows = cdc.cdc_rejects(_changes(spark, sf_dir))
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


@query
def cdc_normalize(spark, sf_dir):
    return _valid_changes(spark, sf_dir).groupBy("table", "type").agg(F.count("*").alias("n"))


@query
def cdc_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("table", "type", _id(), "target", "sink_table")


@query
def cdc_unrouted(spark, sf_dir):
    routes = cdc.route_table(adapters.route_config(spark))
    rows = cdc.cdc_unrouted(_valid_changes(spark, sf_dir), routes)
    return rows.select("table", "type", _id(), "reason")


def _cells(rows: DataFrame) -> DataFrame:
    as_text = F.transform_values("data", lambda _, item: F.try_variant_get(item, "$", "string"))
    return rows.select("table", "sink_table", _id(), F.explode(as_text).alias("column_name", "column_value"))


@query
def cdc_project(spark, sf_dir):
    return _cells(cdc.cdc_project(_routed(spark, sf_dir)))


@query
def cdc_facts(spark, sf_dir):
    return _cells(cdc.cdc_facts(cdc.cdc_project(_routed(spark, sf_dir))))


@query
def cdc_dims(spark, sf_dir):
    return _cells(cdc.cdc_dims(cdc.cdc_project(_routed(spark, sf_dir))))


@query
def dim_upsert(spark, sf_dir):
    return dims.dim_upsert(
        adapters.user_image(spark, sf_dir), adapters.user_changes(spark, sf_dir),
        "id", ["id", "segment", "last_page", "last_view"],
    )


# Orders ----------------------------------------------------------------------------------

def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_wide(
        adapters.order_info(spark, sf_dir), adapters.order_detail(spark, sf_dir), -JOIN_MS, JOIN_MS
    )


@query
def order_event_time(spark, sf_dir):
    exact = adapters.order_detail(spark, sf_dir, "exact").select("id", "create_time", "create_ts")
    return orders.order_event_time(exact.withColumnRenamed("create_ts", "exact_ts"), "day").select(
        "id", "exact_ts", F.col("create_ts").alias("day_ts")
    )


def _pairs(spark, sf_dir, precision, bound_ms):
    headers = orders.header_part(adapters.order_info(spark, sf_dir, precision))
    lines = orders.line_part(adapters.order_detail(spark, sf_dir, precision))
    joined = orders.interval_join(headers, lines, -bound_ms, bound_ms)
    return joined.select("order_id", "detail_id", "sku_id", "header_ts", "line_ts")


@query
def order_interval_join(spark, sf_dir):
    return _pairs(spark, sf_dir, "exact", JOIN_MS)


@query
def order_interval_join_5s(spark, sf_dir):
    return _pairs(spark, sf_dir, "exact", schemas.JOIN_BOUND_MS)


@query
def order_same_day_join(spark, sf_dir):
    return _pairs(spark, sf_dir, "day", schemas.JOIN_BOUND_MS)


@query
def order_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


@query
def order_wide_merge(spark, sf_dir):
    headers = orders.header_part(adapters.order_info(spark, sf_dir)).select(
        "order_id", "order_status", "user_id", "total_amount", "create_date"
    )
    left = headers.where("order_status <> 'F'").withColumn(
        "total_amount", F.when(F.col("total_amount") < 200_000, F.col("total_amount"))
    )
    right = headers.where("total_amount >= 100000").withColumn(
        "create_date", F.when(F.col("order_status") == "O", F.col("create_date"))
    )
    return orders.order_wide_merge(left, right, "order_id")


def _wide_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_wide_dims(
        _wide(spark, sf_dir), adapters.dim_province(spark, sf_dir),
        adapters.dim_user(spark, sf_dir), adapters.dim_sku(spark, sf_dir),
    )


@query
def order_wide_dims(spark, sf_dir):
    return _wide_dims(spark, sf_dir).select(
        "detail_id", "order_id", "sku_id", "user_id", "province_id", "split_total_amount",
        "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
        "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
        "category3_name",
    )


@query
def order_wide_dims_asof(spark, sf_dir):
    """Level and grade of the user and code of the province as they were when the order was made."""
    spark = finely_cut(spark)
    headers = orders.header_part(adapters.order_info(spark, sf_dir))
    joined = orders.interval_join(headers, orders.line_part(adapters.order_detail(spark, sf_dir)), -JOIN_MS, JOIN_MS)
    facts = joined.select("detail_id", "order_id", "user_id", "province_id", "header_ts")
    of_user = asof.as_of(
        facts, adapters.user_history(spark, sf_dir), "user_id", "header_ts", {"user_level": "level", "user_grade": "grade"})
    return asof.as_of(of_user, adapters.province_history(spark, sf_dir), "province_id", "header_ts", {"province_code": "code"})


@query
def order_wide_merge_all(spark, sf_dir):
    """Every order is on both sides, each side with some of its columns blanked."""
    left, right = adapters.partial_orders(spark, sf_dir)
    return orders.order_wide_merge(left, right, "order_id").drop("create_ts")


@query
def order_stats_by_area(spark, sf_dir):
    areas = adapters.dim_province(spark, sf_dir).select(
        F.col("id").alias("province_id"), F.col("area_code").alias("province_area_code"),
    )
    return metrics.order_stats_by_dim(_wide(spark, sf_dir), areas, "province_id", "province_area_code")


@query
def order_stats_by_user(spark, sf_dir):
    return metrics.order_stats(_wide(spark, sf_dir), "user_id")


@query
def order_stats_by_product(spark, sf_dir):
    return metrics.order_stats(_wide(spark, sf_dir), "sku_id")


@query
def order_stats_by_category(spark, sf_dir):
    skus = adapters.dim_sku(spark, sf_dir)
    return metrics.order_stats_by_dim(_wide(spark, sf_dir), skus, "sku_id", "category3_name")


@query
def order_stats_by_brand(spark, sf_dir):
    skus = adapters.dim_sku(spark, sf_dir)
    return metrics.order_stats_by_dim(_wide(spark, sf_dir), skus, "sku_id", "tm_name")
