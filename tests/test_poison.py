"""Records that used to stop a job or vanish: repeated keys, quoted numbers, changes without a
key, operations without a column list, batches in one order."""

import json

import pytest

from clickwell.operators import cdc, dims, logs, orders
from clickwell.schemas import ORDER_INFO, ROUTE_CONFIG, TOPIC_RAW_DB
from clickwell.sources import tables
from clickwell.sources.topics import Topics, read_topic, write_topic
from clickwell.streaming import jobs
from clickwell.streaming.batches import TOPIC_DB_REJECTS

DAY = 86_400_000


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq BIGINT, value STRING")


def test_repeated_keys_keep_the_last(spark):
    lines = texts(
        spark, f'{{"common":{{"mid":"m","is_new":"1"}},"page":{{"page_id":"p"}},"ts":0}}',
        f'{{"common":{{"mid":"m","is_new":"1","x":1,"x":2}},"a":1,"a":2,"page":{{"page_id":"p"}},"ts":{2 * DAY}}}')
    out = logs.visitor_flag_repair(logs.log_valid(logs.parse_log(lines))).orderBy("seq").collect()
    assert json.loads(out[1].value) == {
        "common": {"mid": "m", "is_new": "0", "x": 2}, "a": 2, "page": {"page_id": "p"}, "ts": 2 * DAY}
    shown = texts(spark, '{"common":{"mid":"m"},"page":{"page_id":"p"},"display":[{"k":1,"k":2}],"ts":0}')
    item = logs.display_records(logs.log_valid(logs.parse_log(shown))).selectExpr("to_json(item) AS t").first().t
    assert json.loads(item) == {"k": 2, "page_id": "p"}
    routes = cdc.route_table(tables.local_rows(spark, [
        {"source_table": "t", "operate_type": "insert", "sink_type": "KAFKA", "sink_table": "dwd_t", "row_no": 0}],
        f"{ROUTE_CONFIG}, row_no BIGINT"))
    change = texts(spark, '{"table":"t","type":"insert","y":1,"y":2,"data":{"id":1,"a":1,"b":2,"c":3,"c":4}}')
    row = cdc.fact_messages(cdc.cdc_project(cdc.cdc_route(cdc.parse_cdc(change), routes))).first()
    assert json.loads(row.value)["data"] == {"id": 1, "a": 1, "b": 2, "c": 4} and json.loads(row.value)["y"] == 2


def test_quoted_numbers_count(spark):
    lines = texts(
        spark, '{"id":"1","province_id":"3","total_amount":"9.5","create_time":"2021-02-15 12:00:00"}',
        '{"data":{"id":2,"create_time":"never"}}', '{"id":"x"}', "{bad")
    rows = orders.parse_order_info(lines).collect()
    assert [(r.id, r.province_id) for r in rows] == [(1, 3), (2, None)] and str(rows[0].total_amount) == "9.50"
    assert sorted(r.reason for r in orders.order_rejects(lines, ORDER_INFO).collect()) == ["no_id", "no_id", "no_time"]


def test_completion_breaks_ties_by_value(spark):
    rows = lambda *values: spark.createDataFrame(list(values), "k BIGINT, a STRING")
    merged = orders.order_wide_merge(rows((1, "b"), (1, "a")), rows((1, "0")), "k")
    assert [tuple(r) for r in merged.collect()] == [(1, "a")]


def test_split_queries():
    assert tables.jdbc_options("jdbc:x", "select 1 AS id", "id", 0, 100, 8, fetchsize="10") == {
        "url": "jdbc:x", "dbtable": "(select 1 AS id) t", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "100", "numPartitions": "8", "fetchsize": "10"}
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "select 1", "id")


def test_positions_are_unique_across_batches(spark, tmp_path):
    topics = Topics(format="parquet", root=str(tmp_path / "topics"))
    for batch in range(3):
        write_topic(texts(spark, *"abcd").repartition(2), topics, "t", batch)
    offsets = [r.offset for r in read_topic(spark, topics, "t", stream=False).collect()]
    assert len(set(offsets)) == 12
    by_batch = sorted(offsets)
    assert by_batch[3] < 1 << 43 <= by_batch[4] and by_batch[7] < 2 << 43 <= by_batch[8]


def test_dimension_changes_do_not_depend_on_batches(spark, tmp_path):
    routes = [
        {"source_table": "u", "operate_type": "insert", "sink_type": "HBASE", "sink_table": "dim_u", "sink_columns": "id,name", "row_no": 0},
        {"source_table": "u", "operate_type": "update", "sink_type": "HBASE", "sink_table": "dim_u", "row_no": 1},
        *[{"source_table": f"x{i}", "operate_type": "insert", "sink_type": "HBASE", "sink_table": f"dim_x{i}", "sink_columns": "id", "row_no": 2 + i}
          for i in range(50)]]
    changes = [
        {"table": "u", "type": "insert", "ts": 2, "data": {"id": 1, "name": "new", "x": 1, "y": 2}},
        {"table": "u", "type": "insert", "ts": 1, "data": {"id": 1, "name": "old", "x": 1, "y": 2}},
        {"table": "u", "type": "update", "ts": 3, "data": {"id": 1, "age": 5, "city": "c", "name": "old"}},
        {"table": "u", "type": "insert", "ts": 4, "data": {"name": "no key", "x": 1, "y": 2, "z": 3}}]
    for parts in (1, 4):
        root, schema = str(tmp_path / str(parts)), f"poison{parts}"
        topics = Topics(format="parquet", root=f"{root}/topics")
        size = len(changes) // parts
        for i in range(parts):
            own = texts(spark, *map(json.dumps, changes[i * size:(i + 1) * size])).coalesce(1)
            write_topic(own, topics, TOPIC_RAW_DB, i)
        load = lambda session: tables.local_rows(session, routes, f"{ROUTE_CONFIG}, row_no BIGINT")
        jobs.change_job(
            spark, topics, load, schema, f"{root}/s", f"{root}/dims", {"availableNow": True}, maxFilesPerTrigger="1").awaitTermination()
        assert [t.name for t in spark.catalog.listTables(schema)] == ["dim_u"]
        row = dims.read_dim(spark, dims.dim_table_name(schema, "dim_u")).first()
        assert (row.id, row.name, row.age, row.city) == ("1", "old", "5", "c")
        assert read_topic(spark, topics, TOPIC_DB_REJECTS, stream=False).count() == 1
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
