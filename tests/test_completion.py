"""Records completed over streams; configurations that cannot make a table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from clickwell.operators import orders
from clickwell.schemas import ROUTE_CONFIG, TOPIC_RAW_DB
from clickwell.sources import tables
from clickwell.sources.topics import Topics, read_topic, write_topic
from clickwell.streaming import completion, jobs
from clickwell.streaming.batches import TOPIC_DB_REJECTS, TOPIC_LATE

ONCE = {"availableNow": True}
LAYOUT = "id bigint, amount decimal(16,2), name string, n bigint, at bigint"
HOUR = 3_600_000


@pytest.fixture()
def topics(tmp_path):
    return Topics(format="parquet", root=str(tmp_path / "topics"))


def put(spark, topics, topic, batch_id, records):
    write_topic(spark.createDataFrame([(json.dumps(r),) for r in records], "value STRING"), topics, topic, batch_id)


def complete(spark, topics, state):
    query = jobs.completion_job(spark, topics, ("L", "R"), "OUT", LAYOUT, "id", "at", state, HOUR, ONCE, "10 minutes")
    query.awaitTermination()
    assert not sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return sorted((json.loads(r.value) for r in read_topic(spark, topics, "OUT", stream=False).collect()), key=str)


def test_released_when_complete_or_timed_out(spark, topics, tmp_path):
    big = 2**62 + 1  # more than a float holds
    run = lambda: complete(spark, topics, str(tmp_path / "s"))
    put(spark, topics, "L", 0, [
        {"id": 1, "amount": 1.5, "at": HOUR}, {"id": 2, "amount": 2.25, "name": "two", "n": big, "at": HOUR},
        {"id": 3, "name": "three", "at": HOUR}, {"name": "no key", "at": HOUR}, {"id": 9, "name": "no time"}])
    put(spark, topics, "R", 0, [{"id": 4, "n": 4, "at": HOUR}])
    two = {"id": 2, "amount": 2.25, "name": "two", "n": big}
    assert run() == sorted([two, {"name": "no key"}], key=str)
    # The right side fills what the left one lacks; what comes after a record is out is absorbed.
    put(spark, topics, "L", 1, [{"id": 4, "name": "left", "at": HOUR + 60_000}])
    put(spark, topics, "R", 1, [
        {"id": 1, "amount": 9.75, "name": "right", "n": 7, "at": HOUR + 60_000}, {"id": 2, "amount": 0, "at": HOUR + 60_000},
        {"id": 4, "name": "right", "at": HOUR + 60_000}])
    one = {"id": 1, "amount": 1.5, "name": "right", "n": 7}
    assert run() == sorted([one, two, {"name": "no key"}], key=str)
    # An hour after their last part the others go as they are.
    for side in "LR":
        put(spark, topics, side, 2, [{"id": 100, "at": 5 * HOUR}])
    rest = [{"id": 3, "name": "three"}, {"id": 4, "name": "left", "n": 4}]
    assert run() == sorted([one, two, {"name": "no key"}, *rest], key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_the_batch_merge(spark, topics, tmp_path, parts):
    rng, sides = random.Random(parts), {"L": [], "R": []}
    for i in range(300):
        key = 0 if rng.random() < 0.3 else rng.randrange(80)
        # Values of a key agree where both sides have one, so the order of arrival does not matter.
        full = {"amount": key + 0.25, "name": f"n{key}", "n": key * 10**12}
        record = {"id": key, "at": HOUR + i, **{k: v for k, v in full.items() if rng.random() < 0.5}}
        sides[rng.choice("LR")].append(record)
    for i in range(parts):
        for side, records in sides.items():
            put(spark, topics, side, i, records[i::parts])
    for side in "LR":
        put(spark, topics, side, "end", [{"id": -1, "at": 10**12}])
    frames = [spark.createDataFrame([(json.dumps(r),) for r in sides[s]], "value STRING").select(
        F.from_json("value", LAYOUT).alias("r")).select("r.*").drop("at") for s in "LR"]
    want = orders.order_wide_merge(*frames, "id").select(F.to_json(F.struct("id", "amount", "name", "n")).alias("v")).collect()
    got = [r for r in complete(spark, topics, str(tmp_path / "s")) if r["id"] >= 0]
    assert got == sorted((json.loads(r.v) for r in want), key=str)


def test_other_types_are_refused(spark):
    rows = spark.createDataFrame([(1, 1.5, 1)], "id bigint, x double, at bigint")
    with pytest.raises(ValueError, match="double"):
        completion.completion_stream(rows, rows, "id", "at", 1)


def test_a_route_without_its_key_stops_nothing(spark, topics, tmp_path):
    routes = [
        ("good", "insert", "HBASE", "dim_good", "id,name", "id", None), ("bad", "insert", "HBASE", "dim_bad", "name,age", "id", None)]
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    config = lambda session: tables.local_rows(session, [dict(zip(names, r), row_no=i) for i, r in enumerate(routes)], f"{ROUTE_CONFIG}, row_no BIGINT")
    record = lambda table: {"table": table, "type": "insert", "ts": 1, "data": {"id": 1, "name": "n", "age": 3, "x": 0}}
    put(spark, topics, TOPIC_RAW_DB, 0, [record("good"), record("bad")])
    schema = "bad_config_dims"
    try:
        for _ in range(2):
            jobs.change_job(spark, topics, config, schema, str(tmp_path / "s"), str(tmp_path / "dims"), ONCE).awaitTermination()
        assert [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary] == ["dim_good"]
        assert [json.loads(r.value)["table"] for r in read_topic(spark, topics, TOPIC_DB_REJECTS, stream=False).collect()] == ["bad"]
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_parts_are_merged_by_the_batch(spark, topics, tmp_path):
    """No keyed state that every part looks up by itself; late parts are in quarantine, not lost."""
    def run():
        query = jobs.completion_job(spark, topics, ("L", "R"), "OUT", LAYOUT, "id", "at", str(tmp_path / "s"), HOUR, ONCE, "10 minutes")
        query.awaitTermination()
        assert query.recentProgress and not any(p["stateOperators"] for p in query.recentProgress)

    for side in "LR":
        put(spark, topics, side, 0, [{"id": 1, "name": side, "at": 5 * HOUR}, {"id": 1, "name": "z", "at": 5 * HOUR}])
    run()
    put(spark, topics, "L", 1, [{"id": 2, "name": "late", "at": HOUR}, {"id": 1, "amount": 1, "n": 2, "at": 5 * HOUR}])
    put(spark, topics, "R", 1, [])
    run()
    texts = lambda topic: [json.loads(r.value) for r in read_topic(spark, topics, topic, stream=False).collect()]
    assert texts("OUT") == [{"id": 1, "amount": 1.0, "name": "L", "n": 2}]
    assert [r["_key"] for r in texts(TOPIC_LATE)] == [2]
