"""Wide records completed over streams: partial records of two sources, per column the first value
that is there, the left source's before the right one's.

A record goes out as soon as all its columns are filled, or as it is once `wait_ms` of event time have
passed since the last part of it; after that, the key is forgotten. Parts that come after a record
went out, within that time, are absorbed. What is held per key is two values per column, however
many parts there are; it is carried from one micro-batch to the next in a written folder and met
with the parts of the batch by one aggregation, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickwell.session import drop_folder
from clickwell.sources.topics import Topics, publish_topic
from clickwell.streaming.batches import batch_session, kept
from clickwell.streaming.pairing import SIDES, SideMarks, delay_ms, publish_late, tagged, watermark
from clickwell.streaming.transforms import NO_DELAY


def _known(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.StringType)):
        return kind
    raise ValueError(f"columns to complete are whole numbers, decimals or text, not {kind.simpleString()}")


def _of(side: int, name: str) -> str:
    return f"{'right' if side else 'left'}_{name}"


@dataclass
class Completion:
    """`tagged` parts with `_key` and `_at` to complete records of a key named `key` and columns `names`."""

    key: str
    names: list[str]
    wait_ms: int
    delay: str

    def step(self, topics: Topics, sink: str, state: str) -> Callable[[DataFrame, int], None]:
        """What works off a micro-batch; `state` is the folder of what is carried on."""
        return lambda batch, batch_id: self.work_off(batch, batch_id, topics, sink, state)

    def work_off(self, batch: DataFrame, batch_id: int, topics: Topics, sink: str, state: str) -> None:
        spark, marks = batch_session(batch), SideMarks(f"{state}/marks")
        delay, before = delay_ms(spark, self.delay), marks.before(spark, batch_id)
        with kept(batch) as parts:
            keyed = parts.where("_key IS NOT NULL AND _at IS NOT NULL")
            after, in_time = marks.after(before, keyed, "_at"), F.col("_at") > watermark(before, delay)
            publish_late(keyed.where(~in_time).drop("_side"), topics, sink, batch_id, state)
            with kept(self.merged(self.held(spark, state, batch_id, parts), keyed.where(in_time))) as records:
                value = {name: F.coalesce(*[_of(side, name) for side in SIDES]) for name in self.names}
                whole: Column = reduce(Column.__and__, [column.isNotNull() for column in value.values()], F.lit(True))
                over = F.col("newest") + self.wait_ms < watermark(after, delay)
                out = records.where(~F.col("done") & (whole | over)).select(
                    F.col("_key").alias(self.key), *[column.alias(name) for name, column in value.items()])
                alone = parts.where("_key IS NULL").select(F.col("_key").alias(self.key), *self.names)
                publish_topic(out.unionByName(alone).select(F.to_json(F.struct("*")).alias("value")), topics, sink, batch_id, state)
                records.where(~over).withColumn("done", F.col("done") | whole).write.mode("overwrite").parquet(
                    self.folder(state, batch_id))
        marks.store(spark, batch_id, after)
        drop_folder(spark, self.folder(state, batch_id - 2))

    def merged(self, held: DataFrame, parts: DataFrame) -> DataFrame:
        """What is known of each key. Of one side the smallest value counts."""
        fresh = parts.select("_key", F.col("_at").alias("newest"), F.lit(False).alias("done"), *[
            F.when(F.col("_side") == side, F.col(name)).alias(_of(side, name)) for side in SIDES for name in self.names])
        both = held.unionByName(fresh)
        return both.groupBy("_key").agg(
            F.max("newest").alias("newest"), F.max("done").alias("done"),
            *[F.min(_of(side, name)).alias(_of(side, name)) for side in SIDES for name in self.names])

    def folder(self, state: str, batch_id: int) -> str:
        return f"{state}/held/batch_id={batch_id}"

    def held(self, spark: SparkSession, state: str, batch_id: int, parts: DataFrame) -> DataFrame:
        """What is known after the batch before, nothing before the first."""
        layout = T.StructType([
            T.StructField("_key", parts.schema["_key"].dataType), T.StructField("newest", T.LongType()),
            T.StructField("done", T.BooleanType()),
            *[T.StructField(_of(side, name), parts.schema[name].dataType) for side in SIDES for name in self.names]])
        if batch_id == 0:
            return spark.createDataFrame([], layout)
        return spark.read.schema(layout).parquet(self.folder(state, batch_id - 1))


def completion_stream(
    left: DataFrame, right: DataFrame, key: str, at: str, wait_ms: int, delay: str = NO_DELAY
) -> tuple[DataFrame, Completion]:
    """Streams of partial records with a common `key` and an event time `at` (epoch ms), as one stream of
    parts and what completes them: the key and the other columns of `left`, which `right` may lack
    in part. Records without a key are passed through at once, each on its own; parts without a time do
    not count, late ones go to quarantine."""
    fields = [f for f in left.schema.fields if f.name not in (key, at)]
    kinds = {f.name: _known(f.dataType) for f in [left.schema[key], *fields]}
    names = [f.name for f in fields]
    parts = tagged(left, right).select(
        F.col(key).cast(kinds[key]).alias("_key"), F.col(at).cast("bigint").alias("_at"), "_side",
        *[F.col(name).cast(kinds[name]).alias(name) for name in names])
    return parts, Completion(key, names, wait_ms, delay)
