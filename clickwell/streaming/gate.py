"""A gate in front of a stateful job: records in time go on to a topic of their own, late and
unusable ones to quarantine, so that nothing vanishes in a state store.

A stateful operator drops rows at or behind its watermark, the newest event time of the batches
before less the delay. The gate keeps that mark itself, in a written table, and splits by it. Batches
of the gated topic appear whole and in order, so a job that reads it, with the same delay or a longer
one and without a limit of files, has a watermark no further on than the gate's mark was. It drops
nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.functions.clock import parse_day, parse_time
from clickwell.operators import logs, orders
from clickwell.schemas import ORDER_DETAIL, ORDER_INFO
from clickwell.session import drop_folder
from clickwell.sources.tables import local_rows
from clickwell.sources.topics import Topics, publish_topic
from clickwell.streaming.batches import TOPIC_LATE, batch_session, kept

# A judge adds `ts` (epoch ms) and `reason` (null for usable records) to rows with `value`.
Judge = Callable[[DataFrame], DataFrame]


def log_judge(lines: DataFrame) -> DataFrame:
    """Log records need a visitor and a time."""
    parsed = logs.parse_log(lines)
    broken = F.col("mid").isNull() | F.col("ts").isNull()
    reason = F.when(broken, F.when(logs.is_record(), "incomplete").otherwise("malformed"))
    return parsed.select("value", "ts", reason.alias("reason"))


def order_judge(layout: str, precision: str = "exact") -> Judge:
    """Order records need an id and a time."""
    def judge(lines: DataFrame) -> DataFrame:
        at: Column = {"exact": parse_time, "day": parse_day}[precision]("create_time")
        parsed = orders.parse_orders(lines, layout).withColumn("ts", F.unix_millis(at))
        return parsed.select("value", "ts", F.when(F.col("id").isNull(), "no_id").when(F.col("ts").isNull(), "no_time").alias("reason"))

    return judge


JUDGES: dict[str, Judge] = {
    "log": log_judge, "order_info": order_judge(ORDER_INFO), "order_detail": order_judge(ORDER_DETAIL),
}


@dataclass
class Marks:
    """The newest event time up to each micro-batch, one small file per batch. A replayed batch
    finds the mark of its predecessor as it was."""

    path: str

    def before(self, spark: SparkSession, batch_id: int) -> int:
        """In epoch ms; 0, as in a fresh state store, before there is one."""
        if batch_id == 0:
            return 0
        return spark.read.schema("mark BIGINT").parquet(f"{self.path}/batch_id={batch_id - 1}").first().mark

    def store(self, spark: SparkSession, batch_id: int, mark: int) -> None:
        local_rows(spark, [{"mark": mark}], "mark BIGINT").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        drop_folder(spark, f"{self.path}/batch_id={batch_id - 2}")


@dataclass
class GateStep:
    """Records (value) to the topic `passed`; late ones to `late`, unusable ones to `rejected`."""

    topics: Topics
    passed: str
    rejected: str
    judge: Judge
    state: str
    delay_ms: int = 0
    late: str = TOPIC_LATE

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, marks = batch_session(batch), Marks(f"{self.state}/marks")
        newest_before = marks.before(spark, batch_id)
        with kept(self.judge(batch.select("value", "offset"))) as rows:
            usable = rows.where("reason IS NULL")
            newest = usable.agg(F.max("ts")).first()[0]
            # What a state store that has seen the batches before would drop.
            is_late = F.col("ts") <= max(newest_before - self.delay_ms, 0)
            outputs = {
                self.passed: usable.where(~is_late),
                self.late: usable.where(is_late),
                self.rejected: rows.where("reason IS NOT NULL"),
            }
            for topic, own in outputs.items():
                # Gates share their quarantine topics, so their batches there bear the name of the topic passed to.
                name = batch_id if topic == self.passed else f"{batch_id}-{self.passed}"
                publish_topic(own, self.topics, topic, name, self.state)
            marks.store(spark, batch_id, max(newest_before, newest or 0))
