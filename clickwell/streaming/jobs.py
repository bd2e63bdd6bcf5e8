"""The streaming jobs: sources, steps, checkpoints and sinks wired together.

Each starts one streaming query. `state` is a folder in shared storage for the checkpoint and
the tables a job keeps. Default trigger: every five seconds; `{"availableNow": True}` works
off what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickwell.operators import logs, orders
from clickwell.schemas import (
    BOUNCE_MS, JOIN_BOUND_MS, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_ORDER_WIDE, TOPIC_PAGE, TOPIC_RAW_DB,
    TOPIC_RAW_LOG, TOPIC_UNIQUE_VISIT, TOPIC_USER_JUMP,
)
from clickwell.session import tune
from clickwell.sources.topics import Topics, land_raw_log, publish_topic, read_topic, stream_to_topic
from clickwell.streaming import transforms
from clickwell.streaming.batches import TOPIC_DB_REJECTS, TOPIC_LOG_REJECTS, ChangeStep, FirstVisits, JumpStep, LogStep, kept
from clickwell.streaming.completion import completion_stream
from clickwell.streaming.gate import JUDGES, GateStep
from clickwell.streaming.pairing import IntervalJoinStep, tagged
from clickwell.streaming.waiting import DAY_MS, WideDims, WideDimsStep

EVERY_5_SECONDS = {"processingTime": "5 seconds"}


def run_batches(
    rows: DataFrame, step: Callable[[DataFrame, int], None], name: str, state: str, trigger: dict | None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(step).queryName(name)
    writer = writer.option("checkpointLocation", f"{state}/checkpoint")
    return writer.trigger(**(trigger or EVERY_5_SECONDS)).start()


def collect_job(
    spark: SparkSession, lines: DataFrame, topics: Topics, landing: str, state: str, trigger: dict | None = None
) -> StreamingQuery:
    """Raw log lines (`value`, `arrival`) to the landing folder and on to the raw log topic."""
    def step(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as lines_once:  # two writes, one reading
            land_raw_log(lines_once, topics, TOPIC_RAW_LOG, landing, batch_id)

    return run_batches(lines, step, "collect", state, trigger)


def log_job(
    spark: SparkSession, topics: Topics, state: str, trigger: dict | None = None, **limits: str
) -> StreamingQuery:
    """Raw log to start, page and exposure topics, with the new-visitor flag repaired."""
    lines = read_topic(tune(spark), topics, TOPIC_RAW_LOG, **limits)
    step = LogStep(topics, FirstVisits(f"{state}/first_visits"))
    return run_batches(lines, step, "base_log", state, trigger)


def change_job(
    spark: SparkSession, topics: Topics, load_config: Callable[[SparkSession], DataFrame], schema: str,
    state: str, location: str | None = None, trigger: dict | None = None, **limits: str,
) -> StreamingQuery:
    """Database changes to fact topics and dimension tables."""
    lines = read_topic(tune(spark), topics, TOPIC_RAW_DB, **limits)
    return run_batches(lines, ChangeStep(topics, load_config, schema, f"{state}/config", location), "base_db", state, trigger)


def on_time(topic: str) -> str:
    """The topic that a gate in front of `topic` passes its records on to."""
    return f"{topic}_ON_TIME"


def gate_job(
    spark: SparkSession, topics: Topics, topic: str, kind: str, state: str, delay_ms: int = 0,
    trigger: dict | None = None, **limits: str,
) -> StreamingQuery:
    """Records of a topic that are in time and usable to `on_time(topic)`, the others to quarantine.
    `kind` says what they are: log, order_info or order_detail. A job that reads the gated topic
    takes the same delay and no limit of files, so that batches of the gate stay whole."""
    lines = read_topic(tune(spark), topics, topic, **limits)
    rejected = TOPIC_LOG_REJECTS if kind == "log" else TOPIC_DB_REJECTS
    step = GateStep(topics, on_time(topic), rejected, JUDGES[kind], state, delay_ms)
    return run_batches(lines, step, f"gate_{topic}", state, trigger)


def page_stream(spark: SparkSession, topics: Topics, source: str = TOPIC_PAGE, **limits: str) -> DataFrame:
    """The page topic, parsed; records without visitor or time are left out (a gate quarantines them)."""
    lines = read_topic(spark, topics, source, **limits)
    parsed = logs.log_valid(logs.parse_log(lines))
    return parsed.select("value", "offset", "mid", "is_new", "page_id", "last_page_id", "ts")


def unique_visit_job(
    spark: SparkSession, topics: Topics, state: str, trigger: dict | None = None,
    emit: str = "first_seen", day_start: str = "0 seconds", delay: str = transforms.NO_DELAY,
    source: str = TOPIC_PAGE, **limits: str,
) -> StreamingQuery:
    """Page log to one entry record per visitor and day."""
    rows = transforms.unique_visit_stream(page_stream(tune(spark), topics, source, **limits), delay, emit, day_start)
    return stream_to_topic(rows, topics, TOPIC_UNIQUE_VISIT, f"{state}/checkpoint", trigger)


def bounce_job(
    spark: SparkSession, topics: Topics, state: str, within_ms: int = BOUNCE_MS,
    trigger: dict | None = None, delay: str = transforms.NO_DELAY, source: str = TOPIC_PAGE, **limits: str,
) -> StreamingQuery:
    """Page log to bounces, from session windows."""
    rows = transforms.bounce_stream(page_stream(tune(spark), topics, source, **limits), within_ms, delay)
    return stream_to_topic(rows, topics, TOPIC_USER_JUMP, f"{state}/checkpoint", trigger)


def jump_job(
    spark: SparkSession, topics: Topics, state: str, within_ms: int = BOUNCE_MS,
    delay_ms: int = 0, trigger: dict | None = None, **limits: str,
) -> StreamingQuery:
    """Page log to bounces and in-time follow-ups."""
    lines = read_topic(tune(spark), topics, TOPIC_PAGE, **limits)
    step = JumpStep(topics, f"{state}/carry", within_ms, delay_ms)
    return run_batches(lines, step, "user_jump", state, trigger)


def order_parts(
    spark: SparkSession, topics: Topics, precision: str,
    sources: tuple[str, str] = (TOPIC_ORDER_INFO, TOPIC_ORDER_DETAIL), **limits: str
) -> tuple[DataFrame, DataFrame]:
    """Order headers and lines of the two order topics, those with a time."""
    info = orders.parse_order_info(read_topic(spark, topics, sources[0], **limits))
    detail = orders.parse_order_detail(read_topic(spark, topics, sources[1], **limits))
    headers = orders.header_part(orders.order_event_time(info, precision))
    lines = orders.line_part(orders.order_event_time(detail, precision))
    return headers.where("header_ts IS NOT NULL"), lines.where("line_ts IS NOT NULL")


def order_wide_job(
    spark: SparkSession, topics: Topics, state: str,
    lower_ms: int = -JOIN_BOUND_MS, upper_ms: int = JOIN_BOUND_MS, precision: str = "exact",
    add_dims: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None, delay: str = transforms.NO_DELAY,
    sources: tuple[str, str] = (TOPIC_ORDER_INFO, TOPIC_ORDER_DETAIL),
    tables: WideDims | None = None, wait_ms: int = DAY_MS, **limits: str,
) -> StreamingQuery:
    """Order headers and lines to wide records; late ones go to quarantine. With `tables` they are
    completed from the dimension tables, and those whose rows have not arrived wait for them up to
    `wait_ms`; else `add_dims`, if given, is called per micro-batch."""
    headers, lines = order_parts(tune(spark), topics, precision, sources, **limits)
    parts = tagged(headers.withColumn("_at", F.col("header_ts")), lines.withColumn("_at", F.col("line_ts")))

    def step(batch: DataFrame, batch_id: int) -> None:
        complete = add_dims(batch) if add_dims else batch
        publish_topic(complete.select(F.to_json(F.struct("*")).alias("value")), topics, TOPIC_ORDER_WIDE, batch_id, state)

    out = WideDimsStep(topics, tables, state, wait_ms) if tables else step
    joined = IntervalJoinStep(topics, out, headers.columns, lines.columns, state, lower_ms, upper_ms, delay)
    return run_batches(parts, joined, "order_wide", state, trigger)


def completion_job(
    spark: SparkSession, topics: Topics, sources: tuple[str, str], sink: str, layout: str, key: str, at: str, state: str,
    wait_ms: int = DAY_MS, trigger: dict | None = None, delay: str = transforms.NO_DELAY, **limits: str,
) -> StreamingQuery:
    """Partial records (JSON of `layout`) of two topics to complete ones, by `completion_stream`."""
    tune(spark)
    left, right = (
        read_topic(spark, topics, topic, **limits).select(F.from_json("value", layout).alias("r")).select("r.*") for topic in sources)
    parts, completion = completion_stream(left, right, key, at, wait_ms, delay)
    return run_batches(parts, completion.step(topics, sink, state), f"to_{sink}", state, trigger)
