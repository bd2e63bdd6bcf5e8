"""As-of lookups against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickwell.operators import asof
from clickwell.plans.catalog import QUERIES
from clickwell.session import FIRST_PARTITIONS

DAY = 86_400_000
HISTORY = "id bigint, ts bigint, seq bigint, data map<string,string>"


def cases(seed):
    """Changes and facts of a few keys, one of them with a third of all, many at the same time."""
    rng = random.Random(seed)
    key = lambda: rng.choice([1, 1, 1, 2, 3, 4, 5, 6, None])
    at = lambda: rng.choice([None, rng.randrange(-5 * DAY, 60 * DAY), rng.randrange(20) * DAY])
    changes = []
    for seq in range(400):
        data = {}
        for name in ("level", "grade"):
            if rng.random() < 0.4:
                data[name] = rng.choice([None, "a", "b", str(seq)])
        changes.append((key(), at(), seq % 150, data))
    facts = [(i % 300, key(), at(), "x") for i in range(350)]
    return changes, facts


def expected(changes, facts):
    def value(key, at, name):
        sets = [(ts, seq, (data[name] is not None, data[name] or "")) for k, ts, seq, data in changes
                if k == key and ts is not None and ts <= at and name in data]
        if key is None or at is None or not sets:
            return None
        known, text = max(sets)[2]
        return text if known else None

    return Counter((i, k, at, word, *[None if k is None or at is None else value(k, at, n) for n in ("level", "grade")])
                   for i, k, at, word in facts)


@pytest.mark.parametrize("seed, cell_ms", [(1, asof.CELL_MS), (2, DAY), (3, 1_000 * DAY)])
def test_as_of_equals_brute_force(spark, seed, cell_ms):
    changes, facts = cases(seed)
    rows = asof.as_of(
        spark.createDataFrame(facts, "n bigint, user bigint, at bigint, data string"), spark.createDataFrame(changes, HISTORY),
        "user", "at", {"user_level": "level", "user_grade": "grade"}, cell_ms)
    assert Counter(tuple(r) for r in rows.select("n", "user", "at", "data", "user_level", "user_grade").collect()) == expected(changes, facts)


def test_no_history_and_no_facts(spark):
    facts = spark.createDataFrame([(1, 5)], "user bigint, at bigint")
    nothing = spark.createDataFrame([], HISTORY)
    assert [tuple(r) for r in asof.as_of(facts, nothing, "user", "at", {"v": "level"}).collect()] == [(1, 5, None)]
    assert asof.as_of(facts.where("false"), nothing, "user", "at", {"v": "level"}).count() == 0


def test_facts_are_not_paired_with_versions(spark):
    changes = spark.range(2_000).selectExpr("1L AS id", f"id * {DAY // 50} AS ts", "id AS seq", "map('level', cast(id AS string)) AS data")
    facts = spark.range(500).selectExpr("1L AS user", f"id * {DAY // 20} AS at")
    plan = asof.as_of(facts, changes, "user", "at", {"v": "level"}, DAY)
    assert "CartesianProduct" not in (text := plan._jdf.queryExecution().executedPlan().toString())
    assert "NestedLoop" not in text
    got = {r.at: int(r.v) for r in plan.collect()}
    assert got == {i * (DAY // 20): min(1_999, i * (DAY // 20) // (DAY // 50)) for i in range(500)}


def test_a_task_holds_no_more_for_larger_tables(spark):
    """Shuffles are cut by size, not into a fixed number of partitions; the caller's settings stay."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own, before = QUERIES["order_wide_dims_asof"](spark, "/root/testdata/sf0.001").sparkSession, spark.conf.get(first, None)
    assert int(own.conf.get(first)) == FIRST_PARTITIONS and before is None
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        own.conf.set(key, value)
    facts = own.range(4_000).selectExpr("id % 500 AS k", "id * 1000 AS at", "id AS n")
    history = own.range(4_000).selectExpr("id % 500 AS id", "id * 900 AS ts", "id AS seq", "map('v', string(id)) AS data")
    rows = asof.as_of(facts, history, "k", "at", {"v": "v"})
    assert rows.groupBy(F.spark_partition_id().alias("part")).count().count() > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
