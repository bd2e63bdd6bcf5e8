"""Parsing, quarantine, flag repair and the three-way split of the behaviour log."""

import json
import random

import pytest

from clickwell.operators import logs

DAY = 86_400_000


def lines(spark, values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq BIGINT, value STRING")


def test_flag_repair(spark):
    rows = [
        ("m1", "1", 0, "1"), ("m1", "1", 5, "1"), ("m1", "1", DAY, "0"), ("m1", "1", DAY + 5, "0"),
        ("m1", "0", DAY, "0"), ("m2", "0", 0, "0"), ("m2", "1", DAY, "1"), ("m3", None, DAY, None),
    ]
    log = spark.createDataFrame(
        [(i, mid, flag, ts) for i, (mid, flag, ts, _) in enumerate(rows)],
        "seq BIGINT, mid STRING, is_new STRING, ts BIGINT",
    )
    repaired = logs.visitor_flag_repair(log)
    assert repaired.columns == log.columns
    assert [r.is_new for r in repaired.orderBy("seq").collect()] == [out for *_, out in rows]


def test_flag_repair_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (i, "hot" if rng.random() < 0.33 else f"m{rng.randrange(50)}", rng.choice("01"), rng.randrange(20) * DAY // 3)
        for i in range(2000)
    ]
    first = {}
    for _, mid, flag, ts in rows:
        if flag == "1":
            first[mid] = min(first.get(mid, 10**18), ts // DAY)
    want = {i: "0" if flag == "1" and ts // DAY > first[mid] else flag for i, mid, flag, ts in rows}
    log = spark.createDataFrame(rows, "seq BIGINT, mid STRING, is_new STRING, ts BIGINT").repartition(4)
    assert {r.seq: r.is_new for r in logs.visitor_flag_repair(log).collect()} == want


COMMON = {"mid": "m", "is_new": "1"}
SPLIT = {
    "start": ({"start": {"entry": "icon"}}, (1, 0, 0)),
    "empty start": ({"start": {}, "page": {"page_id": "p"}}, (0, 1, 0)),
    "two exposures": ({"page": {"page_id": "p"}, "display": [{"item": 1}, {"item": 2}]}, (0, 1, 2)),
    "no exposures": ({"page": {"page_id": "p"}, "display": []}, (0, 1, 0)),
    "start with exposures": ({"start": {"entry": "x"}, "display": [{"item": 1}, {"item": 2}]}, (1, 0, 0)),
    "own page": ({"page": {"page_id": "p"}, "display": [{"page": {"page_id": "q"}}]}, (0, 1, 1)),
}


@pytest.mark.parametrize("case", SPLIT)
def test_split(spark, case):
    record, want = SPLIT[case]
    log = logs.log_valid(logs.parse_log(lines(spark, [{"common": COMMON, "ts": 1, **record}])))
    shown = logs.display_records(log)
    assert (logs.start_records(log).count(), logs.page_records(log).count(), shown.count()) == want
    pages = {json.loads(r.item)["page_id"] for r in shown.selectExpr("to_json(item) AS item").collect()}
    assert pages == ({"q"} if case == "own page" else {"p"} if want[2] else set())


def test_bad_lines_are_quarantined(spark):
    values = ["{bad", "", "null", None, {"common": COMMON}, {"page": {}, "ts": 1}, {"common": COMMON, "ts": "7"},
              {"common": "text", "ts": 1}]
    parsed = logs.parse_log(lines(spark, values))
    assert [(r.seq, r.ts) for r in logs.log_valid(parsed).collect()] == [(6, 7)]
    reasons = {r.seq: r.reason for r in logs.log_rejects(parsed).collect()}
    assert reasons == {0: "malformed", 1: "malformed", 2: "malformed", 3: "malformed",
                       4: "incomplete", 5: "incomplete", 7: "incomplete"}


def test_strict_parsing_fails_the_job(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        logs.parse_log(lines(spark, ["{bad"]), strict=True).collect()


def test_repaired_text_loses_nothing(spark):
    record = {"common": {"mid": "m", "is_new": "1", "os": {"v": 2.5}}, "ts": DAY, "page": {"page_id": "p", "x": [1]},
              "err": {"code": 7}}
    first = {"common": {"mid": "m", "is_new": 1}, "ts": 0, "page": {"page_id": "p"}}
    log = logs.log_valid(logs.parse_log(lines(spark, [first, record])))
    out = [r.value for r in logs.visitor_flag_repair(log).orderBy("seq").collect()]
    assert out[0] == json.dumps(first)
    record["common"]["is_new"] = "0"
    assert json.loads(out[1]) == record


def test_each_part_is_parsed_once_and_only_where_read(spark):
    log = logs.log_valid(logs.parse_log(lines(spark, [])))
    plan = lambda rows: rows.select("mid", "page_id", "ts")._jdf.queryExecution().optimizedPlan().toString()
    assert plan(log).count("from_json") == 1 and "start" not in plan(log)
    assert plan(logs.page_records(log)).count("from_json") == 2
