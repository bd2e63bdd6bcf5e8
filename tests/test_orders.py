"""Order event time, interval join, wide record, completion and dimensions."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest

from clickwell.operators import orders
from clickwell.schemas import ORDER_DETAIL, ORDER_INFO, WIDE_FACT_COLUMNS

NOON = datetime(2021, 2, 15, 12, tzinfo=timezone.utc)


def text(at):
    return at.strftime("%Y-%m-%d %H:%M:%S")


def headers(spark, *rows, precision="exact"):
    values = [(json.dumps({"id": i, "create_time": at, "total_amount": 9.5, "user_id": 7, "order_status": "S"}),) for i, at in rows]
    parsed = orders.parse_order_info(spark.createDataFrame(values, "value STRING"))
    return orders.order_event_time(parsed, precision)


def lines(spark, *rows, precision="exact"):
    values = [
        (json.dumps({"table": "x", "data": {"id": i, "order_id": o, "create_time": at, "sku_num": 2, "order_price": "4.75"}}),)
        for i, o, at in rows
    ]
    parsed = orders.parse_order_detail(spark.createDataFrame(values, "value STRING"))
    return orders.order_event_time(parsed, precision)


def pairs(spark, head, line, precision="exact"):
    wide = orders.order_wide(headers(spark, *head, precision=precision), lines(spark, *line, precision=precision))
    return sorted((r.order_id, r.detail_id) for r in wide.collect())


def test_bounds_are_inclusive(spark):
    line = [(s, 1, text(NOON + timedelta(seconds=s))) for s in (-6, -5, 0, 5, 6)]
    assert pairs(spark, [(1, text(NOON))], [*line, (99, 2, text(NOON))]) == [(1, -5), (1, 0), (1, 5)]


def test_day_and_exact_time(spark):
    late, early = "2021-02-15 23:59:58", "2021-02-16 00:00:01"
    assert pairs(spark, [(1, late)], [(1, 1, early)]) == [(1, 1)]
    assert pairs(spark, [(1, late)], [(1, 1, early)], precision="day") == []
    same_day = [(1, 1, "2021-02-15 20:00:00")]
    assert pairs(spark, [(1, text(NOON))], same_day) == []
    assert pairs(spark, [(1, text(NOON))], same_day, precision="day") == [(1, 1)]


def test_event_time(spark):
    at = int(NOON.timestamp() * 1000)
    assert headers(spark, (1, text(NOON))).first().create_ts == at
    assert headers(spark, (1, text(NOON)), precision="day").first().create_ts == at - 12 * 3_600_000
    assert headers(spark, (1, "2021-02-15")).first().create_ts == at - 12 * 3_600_000
    assert headers(spark, (1, "soon")).first().create_ts is None


def test_wide_record(spark):
    row = orders.order_wide(headers(spark, (1, text(NOON))), lines(spark, (5, 1, text(NOON)))).first()
    assert row.__fields__ == [name for name, _ in WIDE_FACT_COLUMNS]
    assert (row.detail_id, row.order_id, row.sku_num, str(row.order_price), str(row.total_amount)) == (5, 1, 2, "4.75", "9.50")
    assert (row.create_date, row.create_hour, row.split_feight_fee) == ("2021-02-15", "12", None)


@pytest.mark.parametrize("lower,upper", [(-5000, 5000), (0, 0), (-700, 3000), (2000, 9000)])
def test_interval_join_against_brute_force(spark, lower, upper):
    """Order 0 has a third of both sides."""
    rng = random.Random(upper)
    pick = lambda: 0 if rng.random() < 0.33 else rng.randrange(1, 60)
    head = [(pick(), rng.randrange(-100_000, 400_000)) for _ in range(300)]
    line = [(i, pick(), rng.randrange(-100_000, 400_000)) for i in range(900)]
    want = sorted((o, t, i) for o, t in head for i, lo, lt in line if o == lo and lower <= lt - t <= upper)
    h = orders.header_part(spark.createDataFrame(head, "id BIGINT, create_ts BIGINT").selectExpr(
        *[f"{n} AS {n}" if n in ("id", "create_ts") else f"CAST(NULL AS {t}) AS {n}" for n, t in fields(ORDER_INFO)]))
    d = orders.line_part(spark.createDataFrame(line, "id BIGINT, order_id BIGINT, create_ts BIGINT").selectExpr(
        *[n if n in ("id", "order_id", "create_ts") else f"CAST(NULL AS {t}) AS {n}" for n, t in fields(ORDER_DETAIL)]))
    joined = orders.interval_join(h, d, lower, upper)
    assert sorted((r.order_id, r.header_ts, r.detail_id) for r in joined.collect()) == want


def fields(ddl):
    from pyspark.sql.types import StructType
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl).fields]


def test_join_of_facts_is_never_broadcast(spark):
    wide = orders.order_wide(headers(spark, (1, text(NOON))), lines(spark, (5, 1, text(NOON))))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "_cell" in plan


def test_completion(spark):
    schema = "order_id BIGINT, a STRING, b STRING"
    left = spark.createDataFrame([(1, "l", None), (2, None, None), (None, "x", None), (None, "x", None)], schema)
    right = spark.createDataFrame([(1, "r", "r"), (3, "r", None), (None, "y", "y")], schema)
    merged = orders.order_wide_merge(left, right, "order_id")
    assert sorted((tuple(r) for r in merged.collect()), key=str) == sorted(
        [(1, "l", "r"), (2, None, None), (3, "r", None), (None, "x", None), (None, "x", None), (None, "y", "y")], key=str
    )


def test_completion_with_a_repeated_key(spark):
    """A key with thousands of copies on both sides gives one record, not their product."""
    copies = lambda a, b: spark.range(3000).selectExpr("1L AS order_id", f"{a} AS a", f"{b} AS b")
    merged = orders.order_wide_merge(copies("'l'", "CAST(NULL AS STRING)"), copies("'r'", "'r'"), "order_id")
    assert [tuple(r) for r in merged.collect()] == [(1, "l", "r")]


def test_unknown_dimension_keys_stay_null(spark):
    wide = spark.sql("SELECT 1L AS sku_id, 2L AS user_id, 3L AS province_id")
    table = lambda cols: spark.sql(f"SELECT {cols} WHERE false")
    row = orders.order_wide_dims(
        wide, table("0L AS id, '' AS name, '' AS area_code, '' AS iso_code, '' AS iso_3166_2"),
        table("0L AS id, 1 AS age, '' AS gender"),
        orders.sku_dimension(
            spark.sql("SELECT 1L AS id, 5L AS spu_id, 6L AS tm_id, 7L AS category3_id"),
            spark.sql("SELECT 5L AS id, 'spu' AS spu_name"), spark.sql("SELECT 6L AS id, 'tm' AS tm_name"),
            table("0L AS id, '' AS name"),
        ),
    ).first()
    assert (row.spu_name, row.tm_name, row.category3_id, row.category3_name) == ("spu", "tm", 7, None)
    assert (row.user_age, row.province_name) == (None, None)
