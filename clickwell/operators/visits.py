"""Visit analysis on the page log: entry pages, unique visits, bounces, follow-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickwell.functions.cells import with_neighbours
from clickwell.functions.clock import day_text
from clickwell.functions.records import is_blank
from clickwell.schemas import BOUNCE_MS


def is_entry() -> Column:
    """The visitor came from outside: no previous page."""
    return is_blank("last_page_id")


def entry_pages(log: DataFrame) -> DataFrame:
    return log.where(is_entry())


def unique_visit(log: DataFrame) -> DataFrame:
    """First entry page per visitor and day. `row_number() = 1` is cut down to one row per
    group in each map task before the shuffle, so a hot visitor costs no more than others."""
    first = Window.partitionBy("mid", "visit_day").orderBy("ts", "seq")
    visits = entry_pages(log).withColumn("visit_day", day_text("ts"))
    return visits.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def jump_detail(log: DataFrame, within_ms: int = BOUNCE_MS, cell_ms: int | None = None) -> DataFrame:
    """Bounces: entry pages with no other event of the visitor less than `within_ms` later."""
    seen = with_neighbours(log, "mid", within_ms, next_fields={}, cell=cell_ms)
    return seen.where(is_entry() & F.col("next").isNull()).drop("next")


def jump_in_time(log: DataFrame, within_ms: int = BOUNCE_MS, cell_ms: int | None = None) -> DataFrame:
    """Follow-ups: events with a page whose immediately preceding event of the visitor is an
    entry page less than `within_ms` earlier."""
    seen = with_neighbours(log, "mid", within_ms, prev_fields={"is_entry": is_entry()}, cell=cell_ms)
    return seen.where(~is_blank("page_id") & F.col("prev.is_entry")).drop("prev")


def jump_split(log: DataFrame, within_ms: int = BOUNCE_MS, cell_ms: int | None = None) -> DataFrame:
    """Both outcomes in one pass, for jobs that write the two outputs. An event may be a
    bounce, a follow-up, both (an entry page after an entry page) or neither."""
    seen = with_neighbours(
        log, "mid", within_ms,
        next_fields={}, prev_fields={"is_entry": is_entry()}, cell=cell_ms,
    )
    return seen.withColumns({
        "is_bounce": is_entry() & F.col("next").isNull(),
        "is_follow_up": ~is_blank("page_id") & F.coalesce(F.col("prev.is_entry"), F.lit(False)),
    }).drop("next", "prev")
