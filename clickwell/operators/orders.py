"""Orders: event time, header/line interval join, the wide order record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickwell.functions import records
from clickwell.functions.cells import CELL_FACTOR, cell_start
from clickwell.functions.clock import parse_day, parse_time
from clickwell.schemas import JOIN_BOUND_MS, ORDER_DETAIL, ORDER_INFO, WIDE_FACT_COLUMNS


def parse_orders(lines: DataFrame, layout: str, strict: bool = False) -> DataFrame:
    """Typed order records, `value` kept; bad ones have nulls. Numbers are read as text first, so quoted ones count."""
    # Routed facts arrive as change records with the row under `data`; bare rows work too.
    kinds = T.StructType.fromDDL(layout)
    row = T.StructType([T.StructField(field.name, T.StringType()) for field in kinds.fields])
    either = T.StructType([*row.fields, T.StructField("data", row)])
    parsed = records.with_once(lines, "_r", records.parse_json("value", either, strict))
    routed = F.col("_r.data").isNotNull()
    fields = [
        F.when(routed, F.col(f"_r.data.{field.name}")).otherwise(F.col(f"_r.{field.name}"))
        .try_cast(field.dataType).alias(field.name)
        for field in kinds.fields
    ]
    return parsed.select("value", *fields)


def parse_order_info(lines: DataFrame, strict: bool = False) -> DataFrame:
    return parse_orders(lines, ORDER_INFO, strict).where("id IS NOT NULL").drop("value")


def parse_order_detail(lines: DataFrame, strict: bool = False) -> DataFrame:
    return parse_orders(lines, ORDER_DETAIL, strict).where("id IS NOT NULL").drop("value")


def order_rejects(lines: DataFrame, layout: str) -> DataFrame:
    """(value, reason) of the order texts that the parsers and the event time leave out."""
    parsed = parse_orders(lines, layout)
    reason = F.when(F.col("id").isNull(), "no_id").when(parse_time("create_time").isNull(), "no_time")
    return parsed.select("value", reason.alias("reason")).where("reason IS NOT NULL")


def order_event_time(rows: DataFrame, precision: str = "exact") -> DataFrame:
    """Set `create_ts` (epoch ms) from `create_time`: to the millisecond, or to the day."""
    at = {"exact": parse_time, "day": parse_day}[precision]("create_time")
    return records.with_once(rows.drop("create_ts"), "create_ts", F.unix_millis(at))


def header_part(headers: DataFrame) -> DataFrame:
    """Order header columns under their wide names, plus `header_ts`. Day and hour are the
    leading parts of `create_time` where the header does not state them."""
    part = lambda start, size: F.nullif(F.substring("create_time", start, size), F.lit(""))
    return headers.select(
        F.col("id").alias("order_id"), "province_id", "order_status", "user_id", "total_amount",
        "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
        "expire_time", "create_time", "operate_time",
        F.coalesce("create_date", part(1, 10)).alias("create_date"),
        F.coalesce("create_hour", part(12, 2)).alias("create_hour"),
        F.col("create_ts").alias("header_ts"),
    )


def line_part(lines: DataFrame) -> DataFrame:
    """Order line columns under their wide names, plus `line_order_id` and `line_ts`."""
    return lines.select(
        F.col("id").alias("detail_id"), F.col("order_id").alias("line_order_id"), "sku_id",
        "order_price", "sku_num", "sku_name", "split_activity_amount", "split_coupon_amount",
        "split_total_amount", F.col("create_ts").alias("line_ts"),
    )


def interval_join(
    headers: DataFrame, lines: DataFrame, lower_ms: int = -JOIN_BOUND_MS, upper_ms: int = JOIN_BOUND_MS
) -> DataFrame:
    """Pairs with the same order id and line time in [header + lower, header + upper].

    Inputs come from `header_part` and `line_part`. Time cells join the id in the key: an id
    with very many rows is spread over tasks, and only rows of touching cells are compared.
    A header falls into at most two cells, a line into one, so no pair appears twice. Both
    sides are facts that grow with the data, so neither is ever broadcast.
    """
    width = CELL_FACTOR * max(upper_ms - lower_ms, 1)
    low = cell_start(F.col("header_ts") + lower_ms, width)
    high = cell_start(F.col("header_ts") + upper_ms, width)
    spread = headers.withColumn("_cell", F.explode(F.array_distinct(F.array(low, high))))
    placed = lines.withColumn("_line_cell", cell_start(F.col("line_ts"), width))
    matches = (
        (F.col("order_id") == F.col("line_order_id"))
        & (F.col("_cell") == F.col("_line_cell"))
        & (F.col("line_ts") - F.col("header_ts")).between(lower_ms, upper_ms)
    )
    return spread.join(placed.hint("merge"), matches, "inner").drop("_cell", "_line_cell")


def wide_columns(parts: DataFrame) -> DataFrame:
    """Select the wide record; columns the input lacks are null."""
    return parts.select(*[
        F.col(name) if name in parts.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in WIDE_FACT_COLUMNS
    ])


def order_wide(
    headers: DataFrame, lines: DataFrame, lower_ms: int = -JOIN_BOUND_MS, upper_ms: int = JOIN_BOUND_MS
) -> DataFrame:
    """Header and line merged into one record. Inputs carry `create_ts`."""
    return wide_columns(interval_join(header_part(headers), line_part(lines), lower_ms, upper_ms))


def order_wide_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Complete wide records from a second source: per column the first non-null wins, `left`
    before `right`, of several on one side the smallest. Records without a key are passed
    through, each on its own.

    Written as an aggregation over both inputs, not as a full join: records of a key that is
    repeated, once or very often, are combined in the map tasks and never paired.
    """
    both = left.withColumn("_side", F.lit(0)).unionByName(
        right.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    names = [name for name in both.columns if name not in (key, "_side")]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    merged = both.withColumn("_alone", alone).groupBy(key, "_alone").agg(*[
        F.min_by(name, F.when(F.col(name).isNotNull(), F.struct("_side", name))).alias(name) for name in names
    ])
    return merged.select(*[name for name in both.columns if name != "_side"])


def sku_with_parts(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """One row per SKU with its SPU, brand and category, and `whole`: whether all of these that it
    names are there. The small tables are joined to each other first, so the order lines meet
    this dimension in a single join."""
    there = F.lit(True)
    tables = [
        spu.select(F.col("id").alias("spu_id"), "spu_name", there.alias("_spu")),
        trademark.select(F.col("id").alias("tm_id"), "tm_name", there.alias("_tm")),
        category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), there.alias("_category3")),
    ]
    base = sku.select(F.col("id").alias("sku_id"), "spu_id", "tm_id", "category3_id")
    joined = reduce(lambda table, small: table.join(small, small.columns[0], "left"), tables, base)
    whole = reduce(Column.__and__, [
        F.col(small.columns[0]).isNull() | F.col(small.columns[2]).isNotNull() for small in tables])
    return joined.withColumn("whole", whole).drop("_spu", "_tm", "_category3")


def sku_dimension(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """One row per SKU with its SPU, brand and category."""
    return sku_with_parts(sku, spu, trademark, category3).drop("whole")


def wide_and_missing(wide: DataFrame, province: DataFrame, user: DataFrame, sku: DataFrame) -> DataFrame:
    """Add province, user and product columns, and `missing`: the dimensions of which a record names
    a row that is not there. `sku` comes from `sku_with_parts`. An unknown id leaves columns null; a
    record without an id lacks nothing.

    A dimension below the broadcast threshold is shipped to the tasks; a larger one is
    joined by sort-merge, where AQE splits the partitions of hot ids.
    """
    there = F.lit(True)
    provinces = province.select(
        F.col("id").alias("province_id"), F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"), there.alias("_has_province"),
    )
    users = user.select(
        F.col("id").alias("user_id"), F.col("age").alias("user_age"), F.col("gender").alias("user_gender"),
        there.alias("_has_user"),
    )
    skus = sku.select(
        "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name", F.col("whole").alias("_has_sku"))
    joined = (
        wide.join(skus, "sku_id", "left").join(users, "user_id", "left").join(provinces, "province_id", "left")
    )
    missing = F.array_compact(F.array(*[
        F.when(F.col(f"{name}_id").isNotNull() & ~F.coalesce(f"_has_{name}", F.lit(False)), F.lit(name))
        for name in ("province", "user", "sku")]))
    added = [c for table in (provinces, users, skus) for c in table.columns[1:-1]]
    return joined.select(*wide.columns, *added, missing.alias("missing"))


def order_wide_dims(wide: DataFrame, province: DataFrame, user: DataFrame, sku: DataFrame) -> DataFrame:
    """Add province, user and product columns; an unknown id leaves them null."""
    return wide_and_missing(wide, province, user, sku.withColumn("whole", F.lit(True))).drop("missing")
