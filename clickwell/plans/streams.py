"""Streaming jobs as queries: land a topic from the test tables, work it off, read the sink.

A topic lands in BATCHES successive time ranges, each a micro-batch of its own. Where a job takes
a delay, records are up to DISORDER_MS out of order within and across the ranges. Each range is
worked off by a run of its own, which resumes from the checkpoint. One record far in the future
ends the topic and moves the watermark past all real ones, so that the last sessions, days and
undecided records come out too. A run fails if a stateful operator drops a row as late.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickwell.operators import dims, logs
from clickwell.plans import adapters
from clickwell.plans.catalog import BOUNCE_MS, JOIN_MS, query
from clickwell.schemas import (
    MONEY, TOPIC_DISPLAY, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_ORDER_WIDE, TOPIC_PAGE, TOPIC_RAW_DB,
    TOPIC_RAW_LOG, TOPIC_START, TOPIC_UNIQUE_VISIT, TOPIC_USER_JUMP,
)
from clickwell.session import folder_exists, move_folder, run_dir, tune
from clickwell.sources.topics import Topics, read_topic, write_topic
from clickwell.streaming import jobs
from clickwell.streaming.batches import TOPIC_IN_TIME, TOPIC_LATE
from clickwell.streaming.waiting import WideDims

ONCE = {"availableNow": True}
BATCHES = 4
DISORDER_MS = adapters.HOUR_MS
DELAY = "1 hour"
STATE_PARTITIONS = 8
END_TS = 4_102_444_800_000
END_MID = "end-of-log"
END_ID = -1
END_ORDER = f'{{"id":{END_ID},"order_id":{END_ID},"create_time":"2100-01-01 00:00:00"}}'
WAIT_MS = 20 * 365 * 24 * adapters.HOUR_MS  # beyond the span of the orders
# The columns of `order_wide_dims`.
WIDE_DIM_FIELDS = [
    ("detail_id", "BIGINT"), ("order_id", "BIGINT"), ("sku_id", "BIGINT"), ("user_id", "BIGINT"), ("province_id", "BIGINT"),
    ("split_total_amount", MONEY), ("province_name", "STRING"), ("province_area_code", "STRING"),
    ("province_iso_code", "STRING"), ("province_3166_2_code", "STRING"), ("user_age", "INT"), ("user_gender", "STRING"),
    ("spu_id", "BIGINT"), ("tm_id", "BIGINT"), ("category3_id", "BIGINT"), ("spu_name", "STRING"), ("tm_name", "STRING"),
    ("category3_name", "STRING"),
]
END_PAGE = f'{{"common":{{"mid":"{END_MID}"}},"page":{{"page_id":"end"}},"ts":{END_TS}}}'


Landing = list[Callable[[], None]]


def folder_topics(root: str) -> Topics:
    return Topics(format="parquet", root=f"{root}/topics")


def job_session(spark: SparkSession, state_partitions: int = STATE_PARTITIONS) -> SparkSession:
    """A session for a job, so that the caller's keeps its settings. Each state partition is a
    store of its own that every micro-batch opens: their number is a parameter of the job."""
    own = tune(spark.newSession())
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def land(
    rows: DataFrame, topics: Topics, topic: str, at: Column, disorder_ms: int = DISORDER_MS, end: str | None = None
) -> Landing:
    """`value` texts in time ranges by their time `at`, moved by up to `disorder_ms` per record: one
    callable per range, which lands it. All ranges are written at once, by as many tasks as read
    the rows; a range lands by the rename of its folder. `end` lands with the last range."""
    spark = rows.sparkSession
    moved = F.coalesce(at, F.lit(0)) + (F.pmod(F.xxhash64("value"), F.lit(disorder_ms)) if disorder_ms else F.lit(0))
    rows = rows.select("value", moved.alias("_at"))
    cuts = rows.agg(F.percentile_approx("_at", [i / BATCHES for i in range(1, BATCHES)], 10_000)).first()[0] or []
    return land_parts(rows.select("value", sum((F.col("_at") > cut).cast("int") for cut in cuts) + F.lit(0)), topics, topic, end)


def land_parts(rows: DataFrame, topics: Topics, topic: str, end: str | None = None) -> Landing:
    """`land` of (value, part) rows, parts being 0 to BATCHES - 1."""
    spark, staged = rows.sparkSession, run_dir(rows.sparkSession, "landing")
    parts = rows.toDF("value", "part")
    if end is not None:
        parts = parts.unionAll(spark.range(1).select(F.lit(end), F.lit(BATCHES - 1)))
    parts.withColumn("offset", F.monotonically_increasing_id()).write.partitionBy("part").parquet(staged)

    def landing(i: int) -> Callable[[], None]:
        def lands() -> None:
            if folder_exists(spark, f"{staged}/part={i}"):
                move_folder(spark, f"{staged}/part={i}", f"{topics.folder(topic)}/batch_id={i}")
        return lands

    return [landing(i) for i in range(BATCHES)]


def work_off(start: Callable[[], StreamingQuery], *landings: Landing) -> None:
    """Run a job on range after range of its topics, each run resuming from the checkpoint. No
    stateful operator may have dropped a row."""
    for ranges in zip(*landings):
        for lands in ranges:
            lands()
        query = start()
        query.awaitTermination()
        for p in query.recentProgress:
            dropped = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
            if dropped:
                raise RuntimeError(f"batch {p['batchId']} of {p['name']} dropped {dropped} late rows")


def none_late(spark: SparkSession, topics: Topics) -> None:
    """No job may have sent a record to quarantine as late."""
    late = read_topic(spark, topics, TOPIC_LATE, stream=False).count()
    if late:
        raise RuntimeError(f"{late} late records")


def set_session(spark: SparkSession) -> SparkSession:
    """`job_session` for a job without state stores: it has as many partitions as any other query."""
    return job_session(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))


def time_in(field: str = "ts") -> Column:
    return F.get_json_object("value", f"$.{field}").try_cast("bigint")


def page_text() -> Column:
    return F.to_json(F.struct(
        F.struct("mid", "is_new").alias("common"), F.struct("page_id", "last_page_id").alias("page"), "ts"
    )).alias("value")


def land_pages(spark: SparkSession, sf_dir: str, topics: Topics) -> Landing:
    return land(adapters.page_log(spark, sf_dir).select(page_text()), topics, TOPIC_PAGE, time_in(), end=END_PAGE)


def read_log(spark: SparkSession, topics: Topics, topic: str) -> DataFrame:
    parsed = logs.parse_log(read_topic(spark, topics, topic, stream=False))
    return parsed.where(F.col("mid") != END_MID)


@query
def stream_collect(spark, sf_dir):
    """Raw lines, broken ones too, by their day of arrival in the landing folder, and what went on to the
    topic: (place, dt, n)."""
    root = run_dir(spark, "collect")
    topics, source = folder_topics(root), f"{root}/source"
    lines = adapters.app_log(spark, sf_dir).join(
        adapters.page_log(spark, sf_dir).select("seq", F.timestamp_millis("ts").alias("arrival")), "seq")
    lines = lines.select("value", "arrival", (F.col("seq") % 2).alias("half"))
    own = job_session(spark)
    for half in (0, 1):
        lines.where(F.col("half") == half).drop("half").write.mode("append").parquet(source)
        work_off(lambda: jobs.collect_job(
            own, own.readStream.schema("value STRING, arrival TIMESTAMP").parquet(source), topics, f"{root}/landing", f"{root}/state", ONCE),
            [lambda: None])
    landed = spark.read.schema("value STRING, dt DATE, batch_id BIGINT").text(f"{root}/landing").groupBy(
        F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count("*").alias("n"))
    sent = read_topic(spark, topics, TOPIC_RAW_LOG, stream=False).agg(F.count("*").alias("n"))
    return landed.select(F.lit("landing").alias("place"), "dt", "n").unionByName(
        sent.select(F.lit("topic").alias("place"), F.lit(None).cast("string").alias("dt"), "n"))


@query
def stream_first_seen(spark, sf_dir):
    """Which record of a day is emitted at once depends on arrival; that there is one per visitor and
    day does not."""
    root = run_dir(spark, "first-seen")
    topics = folder_topics(root)
    landing = land_pages(spark, sf_dir, topics)
    own = job_session(spark)
    work_off(lambda: jobs.unique_visit_job(own, topics, f"{root}/state", ONCE, emit="first_seen", delay=DELAY), landing)
    return logs.log_dates(read_log(spark, topics, TOPIC_UNIQUE_VISIT)).groupBy(
        "mid", F.col("day_dashed").alias("visit_day")).agg(F.count("*").alias("n"))


def _base_log(spark: SparkSession, sf_dir: str, name: str) -> Topics:
    root = run_dir(spark, name)
    topics = folder_topics(root)
    # The flag goes by what came first, so the ranges are in order of time.
    rest = land(adapters.app_log(spark, sf_dir).select("value"), topics, TOPIC_RAW_LOG, time_in(), disorder_ms=0)
    own = job_session(spark)
    work_off(lambda: jobs.log_job(own, topics, f"{root}/state", ONCE), rest)
    return topics


@query
def stream_flag_repair(spark, sf_dir):
    topics = _base_log(spark, sf_dir, "flag-repair")
    rows = [read_log(spark, topics, topic).select("mid", "ts", "is_new") for topic in (TOPIC_START, TOPIC_PAGE)]
    return rows[0].unionByName(rows[1])


@query
def stream_log_split(spark, sf_dir):
    topics = _base_log(spark, sf_dir, "log-split")
    outputs = {"start": TOPIC_START, "page": TOPIC_PAGE}
    rows = [
        read_log(spark, topics, topic).groupBy("page_id").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
        for kind, topic in outputs.items()
    ]
    shown = read_topic(spark, topics, TOPIC_DISPLAY, stream=False)
    shown = shown.groupBy(F.get_json_object("value", "$.page_id").alias("page_id"))
    rows.append(shown.agg(F.count("*").alias("n")).withColumn("kind", F.lit("display")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def stream_unique_visit(spark, sf_dir):
    root = run_dir(spark, "unique-visit")
    topics = folder_topics(root)
    rest = land_pages(spark, sf_dir, topics)
    own = job_session(spark)
    work_off(lambda: jobs.unique_visit_job(
        own, topics, f"{root}/state", ONCE, emit="day_end", delay=DELAY), rest)
    return logs.log_dates(read_log(spark, topics, TOPIC_UNIQUE_VISIT)).select(
        "mid", "page_id", "ts", F.col("day_dashed").alias("visit_day")
    )


@query
def stream_unique_visit_late(spark, sf_dir):
    """Records a whole range late stand in quarantine, the others go through the gate to the unique
    visits: late and on time are all records."""
    root = run_dir(spark, "unique-visit-late")
    topics = folder_topics(root)
    pages = adapters.page_log(spark, sf_dir)
    span = pages.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    own = F.expr(f"((ts - low) * {BATCHES}) div (high - low + 1)")
    part = own + F.when((F.col("seq") % 20 == 7) & (own < BATCHES - 1), 1).otherwise(0)
    landing = land_parts(pages.join(span).select(page_text(), part), topics, TOPIC_PAGE, END_PAGE)
    session, gated = job_session(spark), jobs.on_time(TOPIC_PAGE)
    for lands in landing:
        work_off(lambda: jobs.gate_job(session, topics, TOPIC_PAGE, "log", f"{root}/gate", DISORDER_MS, ONCE), [lands])
        work_off(lambda: jobs.unique_visit_job(
            session, topics, f"{root}/state", ONCE, emit="day_end", delay=DELAY, source=gated), [lambda: None])
    outputs = {"late": TOPIC_LATE, "on_time": gated, "visit": TOPIC_UNIQUE_VISIT}
    rows = [
        read_log(spark, topics, topic).select(F.lit(kind).alias("kind"), "mid", "page_id", "ts")
        for kind, topic in outputs.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def stream_jump(spark, sf_dir):
    root = run_dir(spark, "jump")
    topics = folder_topics(root)
    rest = land_pages(spark, sf_dir, topics)
    own = job_session(spark)
    work_off(lambda: jobs.bounce_job(own, topics, f"{root}/state", BOUNCE_MS, ONCE, DELAY), rest)
    return read_log(spark, topics, TOPIC_USER_JUMP).select("mid", "page_id", "ts")


@query
def stream_jump_in_time(spark, sf_dir):
    root = run_dir(spark, "jump-in-time")
    topics = folder_topics(root)
    rest = land_pages(spark, sf_dir, topics)
    own = job_session(spark)
    work_off(lambda: jobs.jump_job(own, topics, f"{root}/state", BOUNCE_MS, DISORDER_MS, ONCE), rest)
    outputs = {"bounce": TOPIC_USER_JUMP, "in_time": TOPIC_IN_TIME}
    rows = [
        read_log(spark, topics, topic).select(F.lit(kind).alias("kind"), "mid", "page_id", "ts")
        for kind, topic in outputs.items()
    ]
    return rows[0].unionByName(rows[1])


@query
def stream_interval_join(spark, sf_dir):
    root = run_dir(spark, "interval-join")
    topics = folder_topics(root)
    rests = land_orders(spark, sf_dir, topics)
    own = set_session(spark)
    work_off(lambda: jobs.order_wide_job(
        own, topics, f"{root}/state", -JOIN_MS, JOIN_MS, trigger=ONCE, delay=DELAY), *rests)
    none_late(spark, topics)
    values = read_topic(spark, topics, TOPIC_ORDER_WIDE, stream=False)
    wide = F.from_json("value", "order_id BIGINT, detail_id BIGINT, sku_id BIGINT, create_time STRING")
    return values.select(wide.alias("w")).select("w.*")


def land_orders(spark: SparkSession, sf_dir: str, topics: Topics) -> list[Landing]:
    """Order headers and lines, by the same time ranges of their own."""
    return [
        land(rows.select(F.to_json(F.struct("*")).alias("value"), "create_ts"), topics, topic, F.col("create_ts"))
        for topic, rows in (
            (TOPIC_ORDER_INFO, adapters.order_info(spark, sf_dir)), (TOPIC_ORDER_DETAIL, adapters.order_detail(spark, sf_dir)))
    ]


@query
def stream_order_wide_dims(spark, sf_dir):
    """Wide orders completed from the tables that the change job writes. Orders come before the
    dimension rows that land with them, so many wait; the last ones go with an order after the end."""
    root = run_dir(spark, "order-wide-dims")
    topics, location = folder_topics(root), f"{root}/dims"
    schema = "dim_" + root.rsplit("-", 1)[1]
    order_landings = land_orders(spark, sf_dir, topics)
    changes = adapters.dim_changes(spark, sf_dir)
    change_landing = land_parts(changes.select("value", F.pmod(F.xxhash64("value"), F.lit(BATCHES))), topics, TOPIC_RAW_DB)
    own = set_session(spark)

    def order_run() -> StreamingQuery:
        return jobs.order_wide_job(
            own, topics, f"{root}/orders", -JOIN_MS, JOIN_MS, trigger=ONCE, delay=DELAY,
            tables=WideDims(schema), wait_ms=WAIT_MS)

    def two(landing: Landing, i: int) -> Callable[[], None]:
        return lambda: [lands() for lands in landing[i:i + 2]] and None

    def change_run() -> StreamingQuery:
        return jobs.change_job(own, topics, adapters.dim_route_config, schema, f"{root}/changes", location, ONCE)

    for i in range(0, BATCHES, 2):
        work_off(order_run, *[[two(landing, i)] for landing in order_landings])
        work_off(change_run, [two(change_landing, i)])
    for topic in (TOPIC_ORDER_INFO, TOPIC_ORDER_DETAIL):
        write_topic(spark.range(1).select(F.lit(END_ORDER).alias("value")), topics, topic, BATCHES)
    work_off(order_run, [lambda: None])
    none_late(spark, topics)
    fields = ", ".join(f"{name} {kind}" for name, kind in WIDE_DIM_FIELDS)
    values = read_topic(spark, topics, TOPIC_ORDER_WIDE, stream=False).select(F.from_json("value", fields).alias("w")).select("w.*")
    values.where(F.col("order_id") != END_ID).write.parquet(f"{root}/result")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return spark.read.parquet(f"{root}/result")


@query
def stream_order_wide_merge(spark, sf_dir):
    """All orders from two streams of partial ones, the right parts a month after the left ones."""
    root = run_dir(spark, "order-wide-merge")
    topics = folder_topics(root)
    left, right = adapters.partial_orders(spark, sf_dir)
    right = right.withColumn("create_ts", F.col("create_ts") + JOIN_MS)
    sources = (f"{TOPIC_ORDER_INFO}_LEFT", f"{TOPIC_ORDER_INFO}_RIGHT")
    end = f'{{"order_id":{END_ID},"create_ts":{END_TS}}}'
    landings = [
        land(rows.select(F.to_json(F.struct("*")).alias("value"), "create_ts"), topics, topic, F.col("create_ts"), end=end)
        for topic, rows in zip(sources, (left, right))
    ]
    own = set_session(spark)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema.fields)
    work_off(lambda: jobs.completion_job(
        own, topics, sources, "COMPLETE", layout, "order_id", "create_ts", f"{root}/state", 2 * JOIN_MS, ONCE, DELAY), *landings)
    none_late(spark, topics)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema.fields if f.name != "create_ts")
    whole = read_topic(spark, topics, "COMPLETE", stream=False).select(F.from_json("value", fields).alias("w")).select("w.*")
    return whole.where(F.col("order_id") != END_ID)


@query
def stream_cdc_refresh(spark, sf_dir):
    """Facts routed by a configuration that is replaced while the job runs, between the second and
    the third range of changes; (topic, id)."""
    root = run_dir(spark, "cdc-refresh")
    topics = folder_topics(root)
    changes = adapters.cdc_log(spark, sf_dir)
    part = F.coalesce(F.get_json_object("value", "$.data.id").try_cast("bigint") % BATCHES, F.lit(0))
    landing = land_parts(changes.select("value", part), topics, TOPIC_RAW_DB)
    own, held = job_session(spark), {"routes": adapters.ROUTES}
    for i, lands in enumerate(landing):
        if i == BATCHES // 2:
            held["routes"] = adapters.LATER_ROUTES
        work_off(lambda: jobs.change_job(
            own, topics, lambda session: adapters.route_config(session, held["routes"]), "dim_" + root.rsplit("-", 1)[1],
            f"{root}/state", f"{root}/dims", ONCE), [lands])
    facts = [
        read_topic(spark, topics, topic, stream=False).select(
            F.lit(topic).alias("topic"), F.get_json_object("value", "$.data.id").cast("bigint").alias("id"))
        for topic in ("dwd_order", "dwd_order_update", "dwd_order_new", "dwd_supplier")
    ]
    reduce(DataFrame.unionAll, facts).write.parquet(f"{root}/result")
    spark.sql(f"DROP SCHEMA dim_{root.rsplit('-', 1)[1]} CASCADE")
    return spark.read.parquet(f"{root}/result")


@query
def stream_cdc_route(spark, sf_dir):
    """Fact messages, and the rows of the dimension tables, one column value per row."""
    root = run_dir(spark, "cdc-route")
    topics = folder_topics(root)
    rest = land(adapters.cdc_log(spark, sf_dir), topics, TOPIC_RAW_DB, time_in())
    schema, location = "dim_" + root.rsplit("-", 1)[1], f"{root}/dims"
    own = job_session(spark)
    work_off(lambda: jobs.change_job(
        own, topics, adapters.route_config, schema, f"{root}/state", location, ONCE), rest)

    facts = [
        read_topic(spark, topics, topic, stream=False).select(
            F.lit(topic).alias("sink_table"),
            F.get_json_object("value", "$.data.id").cast("bigint").alias("id"),
            F.explode(F.from_json(F.get_json_object("value", "$.data"), "map<string,string>"))
            .alias("column_name", "column_value"),
        )
        for topic in ("dwd_order", "dwd_order_update")
    ]
    rows = facts[0].unionByName(facts[1])
    for sink_table in ("dim_customer", "dim_part"):
        table = dims.dim_table_name(schema, sink_table)
        columns = [c for c in dims.dim_columns(spark, table) if c != "id"]
        image = dims.read_dim(spark, table)
        entries = F.map_from_arrays(F.array(*[F.lit(c) for c in ["id", *columns]]), F.array("id", *columns))
        rows = rows.unionByName(image.select(
            F.lit(sink_table).alias("sink_table"), F.col("id").cast("bigint").alias("id"),
            F.explode(entries).alias("column_name", "column_value"),
        ).where("column_value IS NOT NULL"))
    rows.write.parquet(f"{root}/result")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return spark.read.parquet(f"{root}/result")
