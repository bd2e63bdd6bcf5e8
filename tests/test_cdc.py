"""Change records: validity, routing and projection."""

import json

import pytest

from clickwell.operators import cdc
from clickwell.schemas import ROUTE_CONFIG
from clickwell.sources.tables import local_rows, read_route_config

FOUR = {"id": 1, "name": "a", "price": 1.5, "flag": None}


def changes(spark, *records):
    values = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return cdc.parse_cdc(spark.createDataFrame(values, "seq BIGINT, value STRING"))


def config(spark, *routes):
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    rows = [dict(zip(names, route), row_no=i) for i, route in enumerate(routes)]
    return cdc.route_table(read_route_config(local_rows(spark, rows, f"{ROUTE_CONFIG}, row_no BIGINT")))


def change(table="t", kind="insert", data=FOUR, **more):
    return {"table": table, "type": kind, "data": data, **more}


def test_validity(spark):
    rows = changes(
        spark,
        change(), {"type": "insert", "data": FOUR}, {"table": "t", "type": "insert"}, change(data={}),
        change(data={"a": 1, "b": 2, "c": 3}), {"table": "t", "data": FOUR}, "{bad", change(data="text"),
        change(data=None),
    )
    assert [r.seq for r in cdc.cdc_valid(rows).collect()] == [0]
    assert {r.seq: r.reason for r in cdc.cdc_rejects(rows).collect()} == {
        1: "no_table", 2: "no_data", 3: "too_narrow", 4: "too_narrow", 5: "no_type", 6: "malformed",
        7: "no_data", 8: "no_data",
    }
    assert sorted(r.seq for r in cdc.cdc_valid(rows, min_columns=3).collect()) == [0, 4]
    assert sorted(r.seq for r in cdc.cdc_valid(rows, min_columns=0).collect()) == [0, 4]


def test_snapshot_rows_count_as_inserts(spark):
    rows = cdc.cdc_normalize(changes(spark, change(kind="bootstrap-insert"), change(kind="update")))
    assert [r.type for r in rows.orderBy("seq").collect()] == ["insert", "update"]


def test_routing(spark):
    routes = config(
        spark,
        ("t", "insert", "CLICKHOUSE", "old", None, None, None),
        ("t", "insert", "hbase", "dim_t", "id", None, None),
        ("t", "update", "Kafka", "dwd_t", "", None, None),
        ("u", "insert", "CLICKHOUSE", "ck_u", "id", None, None),
    )
    rows = cdc.cdc_normalize(changes(
        spark, change(kind="bootstrap-insert"), change(kind="update"), change("u"), change("v"), change(kind="delete")
    ))
    routed = cdc.cdc_project(cdc.cdc_route(rows, routes))
    assert sorted((r.seq, r.target, r.sink_table) for r in routed.collect()) == [(0, "dim", "dim_t"), (1, "fact", "dwd_t")]
    assert {r.seq: r.reason for r in cdc.cdc_unrouted(rows, routes).collect()} == {
        2: "unsupported_sink", 3: "no_config", 4: "no_config"
    }
    kept = {r.seq: r.n for r in routed.selectExpr("seq", "size(data) AS n").collect()}
    assert kept == {0: 1, 1: 4}
    assert [r.n for r in cdc.cdc_facts(routed).selectExpr("size(data) AS n").collect()] == [4]


def test_column_list_is_matched_exactly(spark):
    routes = config(spark, ("t", "insert", "HBASE", "dim_t", "id,, name", None, None))
    row = cdc.dim_changes(cdc.cdc_project(cdc.cdc_route(changes(spark, change()), routes))).first()
    assert row.data == {"id": "1"}


def test_fact_message_keeps_the_rest_of_the_record(spark):
    routes = config(spark, ("t", "insert", "KAFKA", "dwd_t", "id,price,flag", None, None))
    rows = cdc.cdc_normalize(changes(spark, change(kind="bootstrap-insert", xid=9, commit=True)))
    row = cdc.fact_messages(cdc.cdc_project(cdc.cdc_route(rows, routes))).first()
    assert row.topic == "dwd_t"
    assert json.loads(row.value) == {
        "table": "t", "type": "insert", "xid": 9, "commit": True, "sink_table": "dwd_t",
        "data": {"id": 1, "price": 1.5, "flag": None},
    }


def test_dimension_values_become_text(spark):
    routes = config(spark, ("t", "insert", "HBASE", "dim_t", None, None, None))
    row = cdc.dim_changes(cdc.cdc_project(cdc.cdc_route(changes(spark, change()), routes))).first()
    assert row.data == {"id": "1", "name": "a", "price": "1.5", "flag": None}


def test_empty_configuration_is_an_error(spark):
    with pytest.raises(ValueError, match="empty"):
        config(spark)


def test_small_configuration_is_broadcast_by_its_size(spark):
    routes = config(spark, ("t", "insert", "KAFKA", "dwd_t", None, None, None))
    routed = cdc.cdc_route(changes(spark, change()), routes)
    text = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
