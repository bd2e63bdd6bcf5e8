"""Two streams that meet, set-based per micro-batch: header/line pairs within a time bound.

What may still meet a later record is carried to the next micro-batch in a written folder, so a batch
costs two joins and one write, and no record is looked up or stored by itself. A replayed batch
starts from what its predecessor left.

The watermark is that of a stateful operator over two sources: the newest event time of the source
that is behind, less the delay, as of the batches before. Records at or behind it go to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.operators import orders
from clickwell.session import drop_folder
from clickwell.sources.tables import local_rows
from clickwell.sources.topics import Topics, publish_topic
from clickwell.streaming.batches import TOPIC_LATE, batch_session, kept

SIDES = (0, 1)


def delay_ms(spark: SparkSession, delay: str) -> int:
    """A delay as streams take it, such as "10 minutes", in ms."""
    return spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL '{delay}')").first()[0]


def tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both streams as one, `_side` being 0 or 1."""
    sides = [rows.withColumn("_side", F.lit(side)) for side, rows in zip(SIDES, (left, right))]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


@dataclass(frozen=True)
class SideMarks:
    """The newest event time of either source up to each micro-batch, one small file per batch."""

    path: str

    def before(self, spark: SparkSession, batch_id: int) -> tuple[int, int]:
        """In epoch ms; 0, as in a fresh state store, where a source has shown none."""
        if batch_id == 0:
            return 0, 0
        return tuple(spark.read.schema("left BIGINT, right BIGINT").parquet(f"{self.path}/batch_id={batch_id - 1}").first())

    def after(self, before: tuple[int, int], rows: DataFrame, at: str) -> tuple[int, int]:
        newest = rows.agg(*[F.max(F.when(F.col("_side") == side, F.col(at))) for side in SIDES]).first()
        return tuple(max(old, new or 0) for old, new in zip(before, newest))

    def store(self, spark: SparkSession, batch_id: int, marks: tuple[int, int]) -> None:
        row = local_rows(spark, [dict(zip(("left", "right"), marks))], "left BIGINT, right BIGINT")
        row.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        drop_folder(spark, f"{self.path}/batch_id={batch_id - 2}")


def watermark(marks: tuple[int, int], delay: int) -> int:
    return max(min(marks) - delay, 0)


def publish_late(late: DataFrame, topics: Topics, label: str, batch_id: int, owner: str) -> None:
    """Late records as JSON to quarantine, which several jobs may share."""
    publish_topic(late.select(F.to_json(F.struct("*")).alias("value")), topics, TOPIC_LATE, f"{batch_id}-{label}", owner)


@dataclass
class IntervalJoinStep:
    """`tagged` headers and lines with an event time `_at` to wide records, which `out` gets per batch:
    each pair with the same order id and line time in [header + lower, header + upper], once."""

    topics: Topics
    out: Callable[[DataFrame, int], None]
    headers: list[str]
    lines: list[str]
    state: str
    lower_ms: int
    upper_ms: int
    delay: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, marks = batch_session(batch), SideMarks(f"{self.state}/join/marks")
        delay, before = delay_ms(spark, self.delay), marks.before(spark, batch_id)
        with kept(batch) as rows:
            after = marks.after(before, rows, "_at")
            in_time = F.col("_at") > watermark(before, delay)
            publish_late(rows.where(~in_time).drop("_at", "_side"), self.topics, "order_wide", batch_id, self.state)
            fresh = self.split(rows.where(in_time))
            held = [self.held(spark, batch_id, side, part) for side, part in zip(SIDES, fresh)]
            pairs = [
                orders.interval_join(headers, lines, self.lower_ms, self.upper_ms)
                for headers, lines in ((held[0].unionByName(fresh[0]), fresh[1]), (fresh[0], held[1]))]
            self.out(orders.wide_columns(reduce(DataFrame.unionByName, pairs)), batch_id)
            # A line yet to come is behind the watermark; so is a header.
            mark = F.lit(watermark(after, delay))
            needed: list[Column] = [F.col("header_ts") + self.upper_ms > mark, F.col("line_ts") - self.lower_ms > mark]
            for side, keep in zip(SIDES, needed):
                held[side].unionByName(fresh[side]).where(keep).write.mode("overwrite").parquet(self.folder(batch_id, side))
        marks.store(spark, batch_id, after)
        drop_folder(spark, f"{self.state}/join/held/batch_id={batch_id - 2}")

    def split(self, rows: DataFrame) -> list[DataFrame]:
        return [rows.where(F.col("_side") == side).select(*names) for side, names in zip(SIDES, (self.headers, self.lines))]

    def folder(self, batch_id: int, side: int) -> str:
        return f"{self.state}/join/held/batch_id={batch_id}/{'right' if side else 'left'}"

    def held(self, spark: SparkSession, batch_id: int, side: int, like: DataFrame) -> DataFrame:
        """What the batch before has left of a side, none before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], like.schema)
        return spark.read.schema(like.schema).parquet(self.folder(batch_id - 1, side))
