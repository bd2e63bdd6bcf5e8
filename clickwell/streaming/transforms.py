"""Streaming forms that Spark's own stateful operators express: DataFrame to DataFrame.

State lives in the state store and leaves it when the watermark passes. `delay` is how late
a record may be; zero means records come in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickwell.functions.clock import day_text, event_time
from clickwell.functions.records import is_blank
from clickwell.operators.visits import entry_pages
from clickwell.schemas import BOUNCE_MS

NO_DELAY = "0 seconds"
DEDUP_SALTS = 32


def with_event_time(log: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    return log.withColumn("at", event_time("ts")).withWatermark("at", delay)


def bounce_stream(log: DataFrame, within_ms: int = BOUNCE_MS, delay: str = NO_DELAY) -> DataFrame:
    """Bounces as they time out. An entry page is a bounce exactly when it is the last event
    of its session, a session being a run of events less than `within_ms` apart. State is
    one record per open session. Sessions are merged before the shuffle.
    """
    # Session windows also merge at exactly the gap, hence one microsecond less.
    gap = f"{within_ms * 1000 - 1} microseconds"
    payload = F.struct(*[name for name in log.columns])
    sessions = with_event_time(log, delay).groupBy("mid", F.session_window("at", gap)).agg(
        F.max_by(payload, F.struct("ts", "offset")).alias("last")
    )
    return sessions.where(is_blank("last.last_page_id")).select("last.*")


def unique_visit_stream(
    log: DataFrame, delay: str = NO_DELAY, emit: str = "day_end", day_start: str = "0 seconds"
) -> DataFrame:
    """First entry page per visitor and day.

    `day_end` gives the earliest one by event time once the day is over; records are combined
    before the shuffle. `first_seen` gives the first one met, at once; duplicates go in two
    steps, first per (visitor, day, salt), so that a hot visitor's records are spread over
    tasks and only a few of them meet in the second step. State of a day leaves with the day.
    `day_start` shifts midnight from UTC: "16 hours" for UTC+8; it has to agree with the
    session time zone.
    """
    day = F.window("at", "1 day", startTime=day_start)
    visits = with_event_time(entry_pages(log), delay)
    if emit == "first_seen":
        salt = F.pmod(F.xxhash64("ts", "value"), F.lit(DEDUP_SALTS))
        salted = visits.withColumn("day", day).drop("at").withColumn("salt", salt)
        kept = salted.dropDuplicates(["mid", "day", "salt"]).dropDuplicates(["mid", "day"])
        return kept.drop("day", "salt").withColumn("visit_day", day_text("ts"))
    payload = F.struct(*[name for name in log.columns])
    firsts = visits.groupBy("mid", day).agg(F.min_by(payload, F.struct("ts", "offset")).alias("first"))
    return firsts.select("first.*").withColumn("visit_day", day_text("ts"))


def daily_uv_stream(log: DataFrame, delay: str = NO_DELAY, day_start: str = "0 seconds") -> DataFrame:
    """Running count of the day's visitors from a fixed-size sketch, for update mode."""
    day = F.window("at", "1 day", startTime=day_start)
    counts = with_event_time(entry_pages(log), delay).groupBy(day).agg(
        F.approx_count_distinct("mid", 0.01).alias("uv")
    )
    return counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("visit_day"), "uv")
