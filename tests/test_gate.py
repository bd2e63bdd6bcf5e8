"""Late records in front of stateful jobs, dimension rows that come late, topics that show a batch once."""

import json

import pytest
from pyspark.sql import functions as F

from clickwell.operators import dims
from clickwell.schemas import (
    ORDER_INFO, TOPIC_ORDER_INFO, TOPIC_ORDER_WIDE, TOPIC_PAGE, TOPIC_UNIQUE_VISIT, TOPIC_USER_JUMP, WIDE_FACT_COLUMNS,
)
from clickwell.sources.topics import Topics, publish_routed, publish_topic, read_topic, write_topic
from clickwell.streaming import gate, jobs, waiting
from clickwell.streaming.batches import TOPIC_DB_REJECTS, TOPIC_LATE, TOPIC_LOG_REJECTS

ONCE = {"availableNow": True}
HOUR = 3_600_000


@pytest.fixture()
def topics(tmp_path):
    return Topics(format="parquet", root=str(tmp_path / "topics"))


def texts(spark, records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value STRING")


def put(spark, topics, topic, batch_id, records):
    write_topic(texts(spark, records).repartition(3), topics, topic, batch_id)


def get(spark, topics, topic):
    return [r.value for r in read_topic(spark, topics, topic, stream=False).collect()]


def page(mid, ts, last=None):
    return {"common": {"mid": mid}, "page": {"page_id": "home", "last_page_id": last}, "ts": ts}


BATCHES = [
    [page("a", 5 * HOUR), page("b", 4 * HOUR), "no json", {"common": {}, "ts": 9}],
    [page("a", 4 * HOUR), page("c", 4 * HOUR + 1), page("d", 30 * HOUR)],  # at the mark: late; a moment after: not
    [page("d", 3 * HOUR), page("e", 29 * HOUR + 1), page("x", 10**13)],
]


@pytest.mark.parametrize("job, sink", [
    (lambda *a: jobs.unique_visit_job(*a, ONCE, emit="day_end", delay="1 hour", source=jobs.on_time(TOPIC_PAGE)), TOPIC_UNIQUE_VISIT),
    (lambda *a: jobs.bounce_job(*a, trigger=ONCE, delay="1 hour", source=jobs.on_time(TOPIC_PAGE)), TOPIC_USER_JUMP),
])
def test_gate_keeps_what_a_state_store_would_drop(spark, topics, tmp_path, job, sink):
    for i, records in enumerate(BATCHES):
        put(spark, topics, TOPIC_PAGE, i, records)
        jobs.gate_job(spark, topics, TOPIC_PAGE, "log", str(tmp_path / "gate"), HOUR, ONCE).awaitTermination()
        query = job(spark, topics, str(tmp_path / "job"))
        query.awaitTermination()
        assert not sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    late = [json.loads(v) for v in get(spark, topics, TOPIC_LATE)]
    passed = [json.loads(v) for v in get(spark, topics, jobs.on_time(TOPIC_PAGE))]
    assert sorted((r["common"]["mid"], r["ts"]) for r in late) == [("a", 4 * HOUR), ("d", 3 * HOUR)]
    assert len(late) + len(passed) + len(get(spark, topics, TOPIC_LOG_REJECTS)) == sum(map(len, BATCHES))
    found = sorted((r["common"]["mid"], r["ts"]) for r in map(json.loads, get(spark, topics, sink)) if r["common"]["mid"] != "x")
    assert found == [("a", 5 * HOUR), ("b", 4 * HOUR), ("c", 4 * HOUR + 1), ("d", 30 * HOUR), ("e", 29 * HOUR + 1)]


def test_replayed_gate_batch_splits_alike(spark, topics, tmp_path):
    step = gate.GateStep(topics, "PASSED", TOPIC_LOG_REJECTS, gate.log_judge, str(tmp_path / "g"), HOUR)
    for i, records in enumerate(BATCHES):
        batch = texts(spark, records).withColumn("offset", F.monotonically_increasing_id())
        step(batch, i)
        once = sorted(get(spark, topics, "PASSED")), sorted(get(spark, topics, TOPIC_LATE))
        step(batch, i)
        assert (sorted(get(spark, topics, "PASSED")), sorted(get(spark, topics, TOPIC_LATE))) == once


def test_order_records_without_id_or_time_are_rejected(spark, topics, tmp_path):
    good = {"id": 1, "create_time": "2024-01-01 00:00:00"}
    put(spark, topics, TOPIC_ORDER_INFO, 0, [good, {"id": 2}, {"create_time": "2024-01-01"}, "{"])
    jobs.gate_job(spark, topics, TOPIC_ORDER_INFO, "order_info", str(tmp_path / "g"), HOUR, ONCE).awaitTermination()
    assert list(map(json.loads, get(spark, topics, jobs.on_time(TOPIC_ORDER_INFO)))) == [good]
    assert len(get(spark, topics, TOPIC_DB_REJECTS)) == 3
    judged = gate.order_judge(ORDER_INFO, "day")(texts(spark, [good, {"id": 2, "create_time": "x"}])).collect()
    assert sorted(str(r.reason) for r in judged) == ["None", "no_time"]


def test_published_batch_is_not_written_again(spark, topics, tmp_path):
    publish_topic(texts(spark, ["1", "2"]), topics, "t", 0, "job")
    reader = read_topic(spark, topics, "t").select("value")
    seen = []
    run = lambda: reader.writeStream.foreachBatch(lambda b, _: seen.extend(r.value for r in b.collect())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start().awaitTermination()
    run()
    publish_topic(texts(spark, ["1", "2"]), topics, "t", 0, "job")  # a replay
    publish_topic(texts(spark, ["3"]), topics, "t", 1, "job")
    run()
    assert sorted(seen) == ["1", "2", "3"]
    publish_topic(texts(spark, ["4"]), topics, "t", 1, "another job")  # takes the place of the other's batch
    assert sorted(get(spark, topics, "t")) == ["1", "2", "4"]


def test_crash_between_routed_topics(spark, topics):
    rows = spark.createDataFrame([("u", "1"), ("v", "2"), (None, "3")], "topic STRING, value STRING")
    publish_topic(rows.where("topic = 'u'"), topics, "u", 7, "job")  # the one that was out before the crash
    publish_routed(rows, topics, 7, "job")
    publish_routed(rows, topics, 7, "job")
    assert [get(spark, topics, t) for t in ("u", "v", "DEFAULT_DATA")] == [["1"], ["2"], ["3"]]


# Waiting for dimensions ------------------------------------------------------------------

def wide(spark, *rows):
    """(detail_id, user_id, province_id, sku_id, create_time)"""
    layout = ", ".join(f"{name} {kind}" for name, kind in WIDE_FACT_COLUMNS)
    names = [name for name, _ in WIDE_FACT_COLUMNS]
    held = [{"detail_id": d, "order_id": d, "user_id": u, "province_id": p, "sku_id": s, "create_time": t} for d, u, p, s, t in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in held], layout)


@pytest.fixture()
def tables(spark, tmp_path):
    schema = f"wait_{tmp_path.name.replace('-', '_')}"
    made = waiting.WideDims(schema)
    yield made
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def change(spark, tables, sink, columns, batch_id, *rows):
    table = dims.ensure_dim_table(spark, tables.schema, sink, columns)
    data = [({k: str(v) for k, v in zip(columns.split(","), r)}, i, i) for i, r in enumerate(rows)]
    dims.append_changes(spark, table, spark.createDataFrame(data, "data map<string,string>, ts bigint, seq bigint"), batch_id)


def test_records_wait_for_their_dimensions(spark, topics, tables, tmp_path):
    step = waiting.WideDimsStep(topics, tables, str(tmp_path / "w"), wait_ms=HOUR)
    out = lambda: {r["detail_id"]: r for r in map(json.loads, get(spark, topics, TOPIC_ORDER_WIDE))}
    day = "2024-01-01 "
    # No table exists yet: what names nothing goes out, what names something waits.
    step(wide(spark, (1, None, None, None, day + "10:00:00"), (2, 7, None, None, day + "10:00:00"), (3, 7, 1, 5, day + "10:00:00"),
              (4, 8, None, None, None)), 0)
    assert set(out()) == {1, 4}
    change(spark, tables, "dim_user_info", "id,age,gender", 0, (7, 30, "F"), (9, "old", "M"))
    change(spark, tables, "dim_base_province", "id,name,area_code,iso_code,iso_3166_2", 0, (1, "p", "a", "i", "x"))
    change(spark, tables, "dim_sku_info", "id,spu_id,tm_id,category3_id", 0, (5, 50, 51, 52))
    step(wide(spark, (5, 9, None, None, day + "10:30:00")), 1)
    assert set(out()) == {1, 2, 4, 5} and out()[2]["user_age"] == 30
    assert out()[5]["user_gender"] == "M" and "user_age" not in out()[5]  # text that is no number
    # The SKU is there, its parts are not.
    for batch_id, (sink, columns, row) in enumerate((
        ("dim_spu_info", "id,spu_name", (50, "s")), ("dim_base_trademark", "id,tm_name", (51, "t")))):
        change(spark, tables, sink, columns, 0, row)
        step(wide(spark), 2 + batch_id)
        assert 3 not in out()
    change(spark, tables, "dim_base_category3", "id,name", 0, (52, "c"))
    step(wide(spark, (6, 70, None, None, day + "10:45:00")), 4)
    assert [out()[3][c] for c in ("spu_name", "tm_name", "category3_name", "province_name")] == ["s", "t", "c", "p"]
    assert 6 not in out()
    # A replay starts from the same waiting records; an hour later they go out without their rows.
    for _ in range(2):
        step(wide(spark, (7, None, None, None, day + "11:45:00")), 5)
    assert set(out()) == set(range(1, 8)) and "user_age" not in out()[6]
    assert len(get(spark, topics, TOPIC_ORDER_WIDE)) == 7


def test_typed_reading_folds_only_wanted_keys(spark, tables):
    change(spark, tables, "dim_user_info", "id,age", 0, (1, 10), (2, 20))
    change(spark, tables, "dim_user_info", "id,age", 1, (1, 11))
    table = dims.dim_table_name(tables.schema, "dim_user_info")
    keys = spark.createDataFrame([(1,), (3,), (None,)], "k bigint")
    assert [tuple(r) for r in dims.read_typed(spark, table, "id BIGINT, age INT, other DATE", keys).collect()] == [(1, 11, None)]
    assert sorted(tuple(r) for r in dims.read_typed(spark, table, "age INT").collect()) == [(11,), (20,)]
    assert dims.read_typed(spark, f"{tables.schema}.NOTHING", "id BIGINT").count() == 0
