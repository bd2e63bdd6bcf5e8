"""Streaming jobs: equal to the batch operators, for any split into micro-batches and across
restarts; sources and sinks."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickwell.operators import dims, logs, metrics, visits
from clickwell.schemas import (
    ROUTE_CONFIG, TOPIC_DEFAULT, TOPIC_DISPLAY, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_ORDER_WIDE, TOPIC_PAGE, TOPIC_RAW_DB,
    TOPIC_RAW_LOG, TOPIC_START, TOPIC_UNIQUE_VISIT, TOPIC_USER_JUMP,
)
from clickwell.sources import tables
from clickwell.sources.topics import Topics, land_raw_log, read_topic, stream_to_console, write_routed, write_topic
from clickwell.streaming import jobs, transforms
from clickwell.streaming.batches import TOPIC_DB_REJECTS, TOPIC_IN_TIME, TOPIC_LATE, TOPIC_LOG_REJECTS, FirstVisits, LogStep

ONCE = {"availableNow": True}
DAY = 86_400_000
END = {"common": {"mid": "end"}, "page": {"page_id": "end"}, "ts": 4_000_000_000_000}


@pytest.fixture()
def topics(tmp_path):
    return Topics(format="parquet", root=str(tmp_path / "topics"))


def put(spark, topics, topic, batch_id, records):
    values = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    write_topic(spark.createDataFrame(values, "value STRING").coalesce(1), topics, topic, batch_id)


def get(spark, topics, topic):
    return [json.loads(r.value) for r in read_topic(spark, topics, topic, stream=False).collect()]


def page_records(seed, n=400):
    """Time-ordered page records; one visitor has a third of them."""
    rng, ts, out = random.Random(seed), 0, []
    for _ in range(n):
        ts += rng.choice([1, 500, 2_000, 4_000, 9_999, 10_000, 10_001, DAY // 20])
        mid = "hot" if rng.random() < 0.33 else f"m{rng.randrange(12)}"
        page = {"page_id": rng.choice(["home", "list", ""])}
        if rng.random() < 0.5:
            page["last_page_id"] = rng.choice(["home", ""])
        out.append({"common": {"mid": mid, "is_new": rng.choice("01")}, "page": page, "ts": ts})
    return out


def feed(spark, topics, topic, records, parts):
    size = -(-len(records) // parts)
    for i in range(parts):
        put(spark, topics, topic, i, records[i * size:(i + 1) * size])


def batch_log(spark, records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return logs.log_valid(logs.parse_log(spark.createDataFrame(rows, "seq BIGINT, value STRING")))


def keys(rows):
    return Counter((r.mid, r.page_id, r.ts) for r in rows.select("mid", "page_id", "ts").collect())


def topic_keys(records):
    return Counter((r["common"]["mid"], r["page"]["page_id"], r["ts"]) for r in records if r["common"]["mid"] != "end")


@pytest.mark.parametrize("parts", [1, 3])
def test_bounces_equal_batch(spark, topics, tmp_path, parts):
    records = page_records(parts)
    want = keys(visits.jump_detail(batch_log(spark, records)))
    feed(spark, topics, TOPIC_PAGE, records, parts)
    run = lambda: jobs.bounce_job(
        spark, topics, str(tmp_path / "s"), trigger=ONCE, maxFilesPerTrigger="1").awaitTermination()
    run()
    early = topic_keys(get(spark, topics, TOPIC_USER_JUMP))
    assert early <= want and sum(want.values()) - sum(early.values()) <= 13  # at most one open session each
    put(spark, topics, TOPIC_PAGE, "end", [END])
    run()  # resumes from the checkpoint
    assert topic_keys(get(spark, topics, TOPIC_USER_JUMP)) == want


@pytest.mark.parametrize("parts", [1, 4])
def test_bounces_and_follow_ups_equal_batch(spark, topics, tmp_path, parts):
    records = page_records(10 + parts)
    log = batch_log(spark, records)
    feed(spark, topics, TOPIC_PAGE, records, parts)
    run = lambda: jobs.jump_job(
        spark, topics, str(tmp_path / "s"), trigger=ONCE, maxFilesPerTrigger="1").awaitTermination()
    run()
    put(spark, topics, TOPIC_PAGE, "end", [END])
    run()
    assert topic_keys(get(spark, topics, TOPIC_USER_JUMP)) == keys(visits.jump_detail(log))
    assert topic_keys(get(spark, topics, TOPIC_IN_TIME)) == keys(visits.jump_in_time(log))
    assert get(spark, topics, TOPIC_LATE) == []


def test_late_records_are_quarantined(spark, topics, tmp_path):
    record = lambda ts: {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": ts}
    put(spark, topics, TOPIC_PAGE, 0, [record(0), record(50_000)])
    put(spark, topics, TOPIC_PAGE, 1, [record(20_000), record(50_000)])
    jobs.jump_job(spark, topics, str(tmp_path / "s"), trigger=ONCE, maxFilesPerTrigger="1").awaitTermination()
    assert [r["ts"] for r in get(spark, topics, TOPIC_LATE)] == [20_000]
    assert [r["ts"] for r in get(spark, topics, TOPIC_USER_JUMP)] == [0]


def test_unique_visits_equal_batch(spark, topics, tmp_path):
    records = page_records(20)
    feed(spark, topics, TOPIC_PAGE, records, 3)
    put(spark, topics, TOPIC_PAGE, "end", [END])
    jobs.unique_visit_job(
        spark, topics, str(tmp_path / "s"), ONCE, emit="day_end", maxFilesPerTrigger="1").awaitTermination()
    want = visits.unique_visit(batch_log(spark, records))
    assert topic_keys(get(spark, topics, TOPIC_UNIQUE_VISIT)) == keys(want)


def test_unique_visits_at_once(spark, topics, tmp_path):
    """`first_seen` emits without waiting; which record of a day it keeps depends on arrival."""
    records = page_records(21)
    feed(spark, topics, TOPIC_PAGE, records, 2)
    run = lambda: jobs.unique_visit_job(
        spark, topics, str(tmp_path / "s"), ONCE, maxFilesPerTrigger="1").awaitTermination()
    run()
    run()
    found = Counter((r["common"]["mid"], r["ts"] // DAY) for r in get(spark, topics, TOPIC_UNIQUE_VISIT))
    want = visits.unique_visit(batch_log(spark, records)).collect()
    assert found == Counter((r.mid, r.ts // DAY) for r in want)


def test_unique_visits_with_shifted_midnight(spark, topics, tmp_path, zone):
    zone("Asia/Shanghai")
    record = lambda ts: {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": ts}
    put(spark, topics, TOPIC_PAGE, 0, [record(DAY + 15 * 3_600_000), record(DAY + 16 * 3_600_000), END])
    for emit in ("first_seen", "day_end"):
        sink = Topics(format="parquet", root=topics.root)
        jobs.unique_visit_job(
            spark, sink, str(tmp_path / emit), ONCE, emit=emit, day_start="16 hours").awaitTermination()
        found = [r["ts"] // 3_600_000 for r in get(spark, sink, TOPIC_UNIQUE_VISIT) if r["common"]["mid"] == "m"]
        assert sorted(found) == [24 + 15, 24 + 16], emit


def test_running_daily_uv(spark, topics, tmp_path):
    records = page_records(22)
    feed(spark, topics, TOPIC_PAGE, records, 1)
    rows = transforms.daily_uv_stream(jobs.page_stream(spark, topics))
    query = rows.writeStream.format("memory").outputMode("complete").queryName("uv").trigger(**ONCE).option(
        "checkpointLocation", str(tmp_path / "s")).start()
    query.awaitTermination()
    want = {r.visit_day: r.uv for r in metrics.daily_uv(batch_log(spark, records)).collect()}
    assert {r.visit_day: r.uv for r in spark.table("uv").collect()} == want


def test_log_job(spark, topics, tmp_path):
    """Three files, a restart in between, folded first visits; equal to the batch result."""
    records = page_records(30)
    for i, record in enumerate(records):
        if i % 7 == 0:
            del record["page"]
            record["start"] = {"entry": "icon"}
        elif i % 5 == 0:
            record["display"] = [{"item": i}, {"item": i, "page": {"page_id": "promo"}}]
    size = len(records) // 3
    step = LogStep(topics, FirstVisits(str(tmp_path / "first"), fold_every=2))
    run = lambda: jobs.run_batches(
        read_topic(spark, topics, TOPIC_RAW_LOG, maxFilesPerTrigger="1"), step, "log", str(tmp_path / "s"), ONCE
    ).awaitTermination()
    put(spark, topics, TOPIC_RAW_LOG, 0, records[:size] + ["{bad", "{}"])
    put(spark, topics, TOPIC_RAW_LOG, 1, records[size:2 * size])
    run()
    put(spark, topics, TOPIC_RAW_LOG, 2, records[2 * size:])
    run()
    batch = logs.visitor_flag_repair(batch_log(spark, records))
    want = Counter((r.mid, r.ts, r.is_new) for r in batch.collect())
    written = [*get(spark, topics, TOPIC_START), *get(spark, topics, TOPIC_PAGE)]
    assert Counter((r["common"]["mid"], r["ts"], r["common"]["is_new"]) for r in written) == want
    assert len(get(spark, topics, TOPIC_START)) == logs.start_records(batch).count()
    shown = Counter((r["item"], r["page_id"]) for r in get(spark, topics, TOPIC_DISPLAY))
    assert shown == Counter(
        (d["item"], "promo" if "page" in d else r["page"]["page_id"]) for r in records for d in r.get("display", []))
    rejects = [r.value for r in read_topic(spark, topics, TOPIC_LOG_REJECTS, stream=False).collect()]
    assert sorted(rejects) == ["{bad", "{}"]


def test_replayed_log_batch_changes_nothing(spark, topics, tmp_path):
    step = LogStep(topics, FirstVisits(str(tmp_path / "first"), fold_every=2))
    record = lambda ts: {"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "p"}, "ts": ts}
    for batch_id, ts in ((0, 0), (1, DAY), (1, DAY), (2, 2 * DAY), (2, 2 * DAY), (3, 3)):
        rows = [(json.dumps(record(ts)), 0)]
        step(spark.createDataFrame(rows, "value STRING, offset BIGINT"), batch_id)
    flags = sorted((r["ts"], r["common"]["is_new"]) for r in get(spark, topics, TOPIC_PAGE))
    assert flags == [(0, "1"), (3, "1"), (DAY, "0"), (2 * DAY, "0")]


def test_change_job_reads_its_configuration_anew(spark, topics, tmp_path):
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    routes = [("user", "insert", "HBASE", "dim_user", "id,name,age", None, None)]

    def load(session):
        rows = [dict(zip(names, route), row_no=i) for i, route in enumerate(routes)]
        return tables.local_rows(session, rows, f"{ROUTE_CONFIG}, row_no BIGINT")

    def change(table, ts, **data):
        return {"table": table, "type": "bootstrap-insert", "ts": ts, "data": {**data, "x": 1, "y": 2}}

    run = lambda: jobs.change_job(
        spark, topics, load, "stream_dims", str(tmp_path / "s"), str(tmp_path / "dims"), ONCE).awaitTermination()
    put(spark, topics, TOPIC_RAW_DB, 0, [
        change("user", 2, id=1, name="new"), change("user", 1, id=1, name="old", age=3), change("order", 3, id=7, n=1), "{bad",
    ])
    run()
    table = dims.dim_table_name("stream_dims", "dim_user")
    assert [tuple(r) for r in dims.read_dim(spark, table).collect()] == [("1", "old", "3")]
    assert len(get_texts(spark, topics, TOPIC_DB_REJECTS)) == 2

    routes.append(("order", "insert", "KAFKA", "dwd_order", "id", None, None))
    put(spark, topics, TOPIC_RAW_DB, 1, [change("order", 4, id=8, n=1), change("user", 5, id=1, age=4)])
    run()
    assert [tuple(r) for r in dims.read_dim(spark, table).collect()] == [("1", "old", "4")]
    assert [r["data"] for r in get(spark, topics, "dwd_order")] == [{"id": 8}]
    assert len(get_texts(spark, topics, TOPIC_DB_REJECTS)) == 2
    spark.sql("DROP SCHEMA stream_dims CASCADE")


def get_texts(spark, topics, topic):
    return [r.value for r in read_topic(spark, topics, topic, stream=False).collect()]


def test_order_wide_job(spark, topics, tmp_path):
    at = lambda s: f"2021-02-15 12:00:{s:02d}"
    put(spark, topics, TOPIC_ORDER_INFO, 0, [{"id": 1, "create_time": at(10), "user_id": 5}, {"id": 2, "create_time": at(11)}])
    put(spark, topics, TOPIC_ORDER_DETAIL, 0, [
        {"id": i, "order_id": 1, "create_time": at(10 + i)} for i in (-6, -5, 0, 5, 6)
    ])
    users = spark.createDataFrame([(5, "F")], "user_id BIGINT, user_gender STRING")
    run = lambda: jobs.order_wide_job(
        spark, topics, str(tmp_path / "s"), add_dims=lambda wide: wide.join(users, "user_id", "left"), trigger=ONCE,
        delay="1 minute").awaitTermination()
    run()
    put(spark, topics, TOPIC_ORDER_DETAIL, 1, [{"id": 99, "order_id": 2, "create_time": at(16)}])
    run()
    found = sorted((r["order_id"], r["detail_id"], r.get("user_gender")) for r in get(spark, topics, TOPIC_ORDER_WIDE))
    assert found == [(1, -5, "F"), (1, 0, "F"), (1, 5, "F"), (2, 99, None)]


@pytest.mark.parametrize("parts", [1, 3])
def test_interval_join_by_the_batch(spark, topics, tmp_path, parts):
    """Equal to all pairs, for repeated and hot ids, over several batches and a replayed one; no record
    is looked up in a state store, late ones are in quarantine."""
    rng = random.Random(parts)
    at = lambda s: f"2021-02-15 12:{s // 60:02d}:{s % 60:02d}"
    headers = [(i, rng.choice([0, 0, 1, 2, 3]), rng.randrange(60)) for i in range(60)]
    lines = [(i, rng.choice([0, 0, 1, 2, 4]), rng.randrange(60)) for i in range(90)]
    info = [{"id": o, "create_time": at(s), "user_id": i} for i, o, s in headers]
    detail = [{"id": i, "order_id": o, "create_time": at(s)} for i, o, s in lines]

    def run():
        query = jobs.order_wide_job(spark, topics, str(tmp_path / "s"), trigger=ONCE, delay="2 minutes")
        query.awaitTermination()
        assert query.recentProgress and not any(p["stateOperators"] for p in query.recentProgress)

    for i in range(parts):
        put(spark, topics, TOPIC_ORDER_INFO, i, info[i::parts])
        put(spark, topics, TOPIC_ORDER_DETAIL, i, detail[i::parts])
        run()
    want = Counter((h, d) for h, o, s in headers for d, of, t in lines if o == of and -5 <= t - s <= 5)
    assert Counter((r["user_id"], r["detail_id"]) for r in get(spark, topics, TOPIC_ORDER_WIDE)) == want
    # An hour later nothing is held any more, and what comes from before is late.
    for topic in (TOPIC_ORDER_INFO, TOPIC_ORDER_DETAIL):
        put(spark, topics, topic, parts, [{"id": 1000, "order_id": 1001, "create_time": "2021-02-15 13:30:00"}])
    run()
    for side, n in (("left", 1), ("right", 1)):
        assert spark.read.parquet(str(tmp_path / f"s/join/held/batch_id={parts}/{side}")).count() == n
    put(spark, topics, TOPIC_ORDER_DETAIL, parts + 1, [{"id": 7, "order_id": 0, "create_time": at(30)}])
    run()
    assert Counter((r["user_id"], r["detail_id"]) for r in get(spark, topics, TOPIC_ORDER_WIDE)) == want
    assert [r["detail_id"] for r in get(spark, topics, TOPIC_LATE)] == [7]


def test_topics(spark, topics):
    rows = [("a", "1"), ("b", "2"), ("a", "3"), (None, "4")]
    messages = spark.createDataFrame(rows, "topic STRING, value STRING")
    write_routed(messages, topics, 0)
    write_routed(messages, topics, 0)
    assert sorted(get_texts(spark, topics, "a")) == ["1", "3"]
    write_routed(messages, topics, 1)
    assert sorted(get_texts(spark, topics, "a")) == ["1", "1", "3", "3"]
    assert get_texts(spark, topics, "b") == ["2", "2"]
    assert get_texts(spark, topics, TOPIC_DEFAULT) == ["4", "4"]


def test_raw_lines_land_by_arrival_day(spark, topics, tmp_path):
    lines = spark.createDataFrame([("x", "2021-02-15 23:59:59"), ("{bad", "2021-02-16 00:00:00")], "value STRING, t STRING")
    lines = lines.select("value", F.to_timestamp("t").alias("arrival"))
    landing = str(tmp_path / "landing")
    for _ in range(2):
        land_raw_log(lines, topics, TOPIC_RAW_LOG, landing, 0)
    landed = spark.read.format("text").load(landing)
    assert sorted((r.value, str(r.dt)) for r in landed.collect()) == [("x", "2021-02-15"), ("{bad", "2021-02-16")]
    assert sorted(get_texts(spark, topics, TOPIC_RAW_LOG)) == ["x", "{bad"]


def test_collect_job(spark, topics, tmp_path):
    put(spark, topics, "HTTP", 0, ["a", "b"])
    lines = read_topic(spark, topics, "HTTP")
    jobs.collect_job(spark, lines, topics, str(tmp_path / "l"), str(tmp_path / "s"), ONCE).awaitTermination()
    assert sorted(get_texts(spark, topics, TOPIC_RAW_LOG)) == ["a", "b"]
    assert spark.read.format("text").load(str(tmp_path / "l")).count() == 2


def test_console(spark, topics, tmp_path):
    put(spark, topics, "DEBUG", 0, ["a"])
    query = stream_to_console(read_topic(spark, topics, "DEBUG"), "debug", str(tmp_path / "s"), ONCE)
    query.awaitTermination()
    assert query.exception() is None


def test_table_sources(spark):
    rows = spark.createDataFrame([(1, "x")], "source_table INT, sink_pk STRING")
    assert tables.camel_columns(rows).columns == ["sourceTable", "sinkPk"]
    assert tables.jdbc_options("jdbc:x", "select 1", fetchsize="10") == {"url": "jdbc:x", "query": "select 1", "fetchsize": "10"}
