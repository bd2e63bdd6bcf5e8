"""Entry pages, unique visits, bounces and follow-ups on small fixtures and against brute force."""

import random

import pytest

from clickwell.functions.cells import with_neighbours
from clickwell.operators import metrics, visits
from clickwell.operators.logs import log_valid, parse_log
from pyspark.sql import functions as F

SCHEMA = "mid STRING, page_id STRING, last_page_id STRING, ts BIGINT, seq BIGINT"

# Four hand-made page events.
SAMPLE = [
    '{"common":{"mid":"101"},"page":{"page_id":"home"},"ts":10000} ',
    '{"common":{"mid":"102"},"page":{"page_id":"home"},"ts":12000}',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list","last_page_id":"home"},"ts":15000} ',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list","last_page_id":"detail"},"ts":30000} ',
]


def page_log(spark, rows):
    """rows of one visitor: (page_id, last_page_id, ts)"""
    return spark.createDataFrame([("m", p, l, ts, i) for i, (p, l, ts) in enumerate(rows)], SCHEMA)


def times(rows):
    return sorted(r.ts for r in rows.collect())


def test_sample_events(spark):
    log = log_valid(parse_log(spark.createDataFrame([(v,) for v in SAMPLE], "value STRING")))
    log = log.withColumn("seq", F.col("ts"))
    found = [(r.mid, r.page_id, r.ts) for r in visits.jump_detail(log).collect()]
    assert found == [("101", "home", 10000)]
    found = [(r.mid, r.page_id, r.ts) for r in visits.jump_in_time(log).collect()]
    assert found == [("102", "good_list", 15000)]


CASES = {
    "gap just under the bound": ([("home", None, 0), ("list", "home", 9999)], [], [9999]),
    "gap exactly the bound": ([("home", None, 0), ("list", "home", 10000)], [0], []),
    "entry followed by entry": ([("home", None, 0), ("home", None, 5000)], [5000], [5000]),
    "follower without a page": ([("home", None, 0), (None, "home", 3000)], [], []),
    "follower with an empty page": ([("home", None, 0), ("", "home", 3000)], [], []),
    "empty string as last page": ([("home", "", 0)], [0], []),
    "not an entry": ([("list", "home", 0)], [], []),
    "same time, order by seq": ([("home", None, 0), ("list", "home", 0)], [], [0]),
    "follower in the next cell": ([("home", None, 79_999), ("list", "home", 80_000)], [], [80_000]),
    "strict contiguity": ([("home", None, 0), ("", "home", 1), ("list", "x", 2)], [], []),
}


@pytest.mark.parametrize("case", CASES)
def test_bounce_cases(spark, case):
    rows, bounces, follow_ups = CASES[case]
    log = page_log(spark, rows)
    assert times(visits.jump_detail(log)) == bounces
    assert times(visits.jump_in_time(log)) == follow_ups
    split = visits.jump_split(log)
    assert times(split.where("is_bounce")) == bounces
    assert times(split.where("is_follow_up")) == follow_ups


def random_log(seed, n=3000):
    """Time-ordered events of which one visitor has a third; some times repeat."""
    rng = random.Random(seed)
    rows, ts = [], -50_000
    for seq in range(n):
        ts += rng.choice([0, 1, 500, 2_000, 4_000, 9_999, 10_000, 10_001, 60_000])
        mid = "hot" if rng.random() < 0.33 else f"m{rng.randrange(40)}"
        rows.append((mid, rng.choice(["home", "list", "", None]), rng.choice([None, "", "home"]), ts, seq))
    return rows


def brute_force(rows, within):
    bounces, follow_ups, by_mid = [], [], {}
    for row in rows:
        by_mid.setdefault(row[0], []).append(row)
    for events in by_mid.values():
        events.sort(key=lambda r: (r[3], r[4]))
        for before, event, after in zip([None, *events], events, [*events[1:], None]):
            if not event[2] and (after is None or after[3] - event[3] >= within):
                bounces.append(event[4])
            if before and not before[2] and event[3] - before[3] < within and event[1]:
                follow_ups.append(event[4])
    return sorted(bounces), sorted(follow_ups)


@pytest.mark.parametrize("seed,cell", [(1, None), (2, 10_000), (3, 37_123)])
def test_bounces_against_brute_force(spark, seed, cell):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, SCHEMA).repartition(5)
    bounces, follow_ups = brute_force(rows, 10_000)
    assert sorted(r.seq for r in visits.jump_detail(log, cell_ms=cell).collect()) == bounces
    assert sorted(r.seq for r in visits.jump_in_time(log, cell_ms=cell).collect()) == follow_ups
    split = visits.jump_split(log, cell_ms=cell)
    assert split.count() == len(rows)
    assert sorted(r.seq for r in split.where("is_bounce").collect()) == bounces
    assert sorted(r.seq for r in split.where("is_follow_up").collect()) == follow_ups


def test_cell_must_hold_the_bound(spark):
    with pytest.raises(ValueError):
        with_neighbours(page_log(spark, []), "mid", 10_000, next_fields={}, cell=9_999)


def test_hot_visitor_is_spread_over_tasks(spark):
    """The window is keyed by visitor and cell, never by visitor alone."""
    plan = visits.jump_detail(page_log(spark, CASES["not an entry"][0]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert keys and all("_cell" in line for line in keys)


def test_unique_visit_keeps_one_row_per_task(spark):
    text = visits.unique_visit(page_log(spark, []))._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


HOUR = 3_600_000
DAY = 24 * HOUR


def test_unique_visit_days(spark):
    log = page_log(spark, [
        ("home", None, 8 * HOUR), ("home", None, 9 * HOUR), ("home", "", DAY), ("list", "home", DAY + 10 * HOUR),
    ])
    assert times(visits.unique_visit(log)) == [8 * HOUR, DAY]
    assert {r.visit_day: r.uv for r in metrics.daily_uv(log).collect()} == {"1970-01-01": 1, "1970-01-02": 1}
    assert times(visits.entry_pages(log)) == [8 * HOUR, 9 * HOUR, DAY]


def test_unique_visit_follows_the_session_zone(spark, zone):
    log = page_log(spark, [("home", None, DAY + 15 * HOUR), ("home", None, DAY + 16 * HOUR)])
    assert times(visits.unique_visit(log)) == [DAY + 15 * HOUR]
    zone("Asia/Shanghai")  # midnight there is 16:00 UTC
    assert times(visits.unique_visit(log)) == [DAY + 15 * HOUR, DAY + 16 * HOUR]


def test_approximate_uv_is_close(spark):
    log = spark.range(5000).selectExpr(
        "CAST(id AS STRING) AS mid", "'home' AS page_id", "NULL AS last_page_id", "1000L AS ts", "id AS seq"
    )
    assert abs(metrics.daily_uv_approx(log).first().uv - 5000) < 250


def test_bounce_rate(spark):
    log = page_log(spark, [("home", None, 0), ("list", "home", 5000), ("home", None, 100_000)])
    row = metrics.bounce_rate(log).first()
    assert (row.visits, row.bounces, row.bounce_rate) == (2, 1, 0.5)
