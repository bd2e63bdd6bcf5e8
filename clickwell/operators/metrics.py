"""The metrics the intermediate tables exist for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickwell.functions.cells import with_neighbours
from clickwell.functions.clock import day_text
from clickwell.operators.visits import entry_pages, is_entry
from clickwell.schemas import BOUNCE_MS


def daily_uv(log: DataFrame) -> DataFrame:
    """Daily unique visitors: distinct visitors with an entry page."""
    visits = entry_pages(log).select("mid", day_text("ts").alias("visit_day"))
    return visits.groupBy("visit_day").agg(F.count_distinct("mid").alias("uv"))


def daily_uv_approx(log: DataFrame, relative_sd: float = 0.01) -> DataFrame:
    """The same with a bounded-size sketch per day, for dashboards over long histories."""
    visits = entry_pages(log).select("mid", day_text("ts").alias("visit_day"))
    return visits.groupBy("visit_day").agg(F.approx_count_distinct("mid", relative_sd).alias("uv"))


def bounce_rate(log: DataFrame, within_ms: int = BOUNCE_MS, cell_ms: int | None = None) -> DataFrame:
    """Bounces over visits, per day of the entry page."""
    seen = with_neighbours(log, "mid", within_ms, next_fields={}, cell=cell_ms)
    per_day = seen.where(is_entry()).groupBy(day_text("ts").alias("visit_day")).agg(
        F.count("*").alias("visits"),
        F.count_if(F.col("next").isNull()).alias("bounces"),
    )
    return per_day.withColumn("bounce_rate", F.col("bounces") / F.col("visits"))


def order_stats(wide: DataFrame, *by: str) -> DataFrame:
    """Order lines, pieces and amount per group of the wide order table."""
    return wide.groupBy(*by).agg(
        F.count("*").alias("order_lines"),
        F.sum("sku_num").alias("pieces"),
        F.sum("split_total_amount").alias("amount"),
    )


def order_stats_by_dim(wide: DataFrame, dimension: DataFrame, key: str, *by: str) -> DataFrame:
    """The same per attribute of a dimension. The orders are summed per key first: a hot key
    is combined map-side and reaches the join with the dimension as a single row."""
    per_key = order_stats(wide, key)
    described = per_key.join(dimension.select(key, *by), key, "left")
    return described.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in ("order_lines", "pieces", "amount")]
    )
