"""Topics as sources and sinks: a message queue, or a folder with one sub-folder per topic.

The folder form is parquet with one JSON text per row and its position in the batch that wrote
it; tests and back-fills use it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickwell.schemas import TOPIC_DEFAULT
from clickwell.session import drop_folder, files_at, folder_exists, move_folder, touch

# Room for the positions of one written batch: 1,024 tasks of 2^33 rows.
BATCH_POSITIONS = 1 << 43
# Room for the offsets of one partition of a queue's topic.
PARTITION_POSITIONS = 1 << 48


@dataclass(frozen=True)
class Topics:
    """Where topics live. `options` are source and sink options of the format, such as
    `kafka.bootstrap.servers`; `root` is the place of the folder form."""

    format: str = "kafka"
    root: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def folder(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"


def read_topic(
    spark: SparkSession, topics: Topics, topic: str, *, stream: bool = True, **limits: str
) -> DataFrame:
    """Text records of a topic: `value`, `offset` to order records, and `arrival`, the time the
    record reached the topic.

    A queue orders records within a partition only, so `offset` puts the partition first: records
    that have to stay in order, such as the changes of one key, must share a partition.

    `limits` bound a micro-batch: maxOffsetsPerTrigger for the queue, maxFilesPerTrigger or
    maxBytesPerTrigger for the folder. Positions are kept in the query's checkpoint.
    """
    reader = (spark.readStream if stream else spark.read).options(**topics.options, **limits)
    if topics.format == "kafka":
        rows = reader.format("kafka").option("subscribe", topic).load()
        value = F.col("value").cast("string").alias("value")
        position = F.col("partition").cast("bigint") * PARTITION_POSITIONS + F.col("offset")
        return rows.select(value, position.alias("offset"), F.col("timestamp").alias("arrival"))
    rows = reader.format("parquet").schema("value STRING, offset BIGINT").load(topics.folder(topic))
    # Positions count within the batch that wrote them; batches follow each other by number.
    batch = F.regexp_extract("_metadata.file_path", r"batch_id=(\d+)", 1).try_cast("bigint")
    position = F.coalesce(batch, F.lit(0)) * BATCH_POSITIONS + F.col("offset")
    return rows.select("value", position.alias("offset"), F.col("_metadata.file_modification_time").alias("arrival"))


def _positioned(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*names).withColumn("offset", F.monotonically_increasing_id())


def write_topic(rows: DataFrame, topics: Topics, topic: str, batch_id: int | str) -> None:
    """Append `value` texts to a topic. Writing the same batch again replaces it in the folder
    form; the queue's sink is at-least-once."""
    if topics.format == "kafka":
        rows.select("value").write.format("kafka").options(**topics.options).option("topic", topic).save()
    else:
        batch = f"{topics.folder(topic)}/batch_id={batch_id}"
        _positioned(rows, "value").write.mode("overwrite").parquet(batch)


def write_routed(messages: DataFrame, topics: Topics, batch_id: int | str) -> None:
    """Write (topic, value) rows, each to its own topic; rows that name none go to a default."""
    messages = messages.withColumn("topic", F.coalesce("topic", F.lit(TOPIC_DEFAULT)))
    if topics.format == "kafka":
        messages.select("topic", "value").write.format("kafka").options(**topics.options).save()
    else:
        # batch_id is the inner level, so a topic folder can be read on its own; only the
        # partitions this batch writes are replaced when it is replayed.
        (
            _positioned(messages, "topic", "value").withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "batch_id").parquet(topics.root)
        )


def _published(spark: SparkSession, place: str, mark: str) -> bool:
    """Whether the folder is there with the writer's mark; another writer's folder is removed."""
    if folder_exists(spark, f"{place}/{mark}"):
        return True
    drop_folder(spark, place)
    return False


def publish_topic(rows: DataFrame, topics: Topics, topic: str, batch_id: int | str, owner: str = "") -> None:
    """`write_topic` for a batch that may be replayed: in the folder form it appears whole, by one
    rename of a finished folder, and once. A batch that the same `owner` (a job's state folder) has
    published is not written again, so whoever reads the topic as a stream sees none of its records
    twice; its rows are still computed, for the sake of state stores behind them."""
    if topics.format == "kafka":
        return write_topic(rows, topics, topic, batch_id)
    spark, batch, mark = rows.sparkSession, f"batch_id={batch_id}", _mark(owner)
    if _published(spark, f"{topics.folder(topic)}/{batch}", mark):
        return rows.write.format("noop").mode("overwrite").save()
    staged = f"{topics.root}/_staged/{topic}/{batch}"
    _positioned(rows, "value").write.mode("overwrite").parquet(staged)
    touch(spark, f"{staged}/{mark}")
    return move_folder(spark, staged, f"{topics.folder(topic)}/{batch}")


def _mark(owner: str) -> str:
    return f"_by-{sha256(owner.encode()).hexdigest()[:16]}"


def publish_routed(messages: DataFrame, topics: Topics, batch_id: int | str, owner: str = "") -> None:
    """`write_routed` for a batch that may be replayed: one write for all topics, then each topic's
    folder appears as in `publish_topic`. After a crash in between, the rest is published."""
    if topics.format == "kafka":
        return write_routed(messages, topics, batch_id)
    spark, staged, mark = messages.sparkSession, f"{topics.root}/_staged/_routed/batch_id={batch_id}", _mark(owner)
    named = messages.withColumn("topic", F.coalesce("topic", F.lit(TOPIC_DEFAULT)))
    _positioned(named, "topic", "value").write.mode("overwrite").partitionBy("topic").parquet(staged)
    files, folder = files_at(spark, staged)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("topic=") and not _published(spark, place := f"{topics.root}/{name}/batch_id={batch_id}", mark):
            touch(spark, f"{staged}/{name}/{mark}")
            move_folder(spark, f"{staged}/{name}", place)
    return drop_folder(spark, staged)


def stream_to_topic(
    rows: DataFrame, topics: Topics, topic: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write a streaming DataFrame of `value` texts to a topic in append mode."""
    writer = rows.select("value").writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.queryName(f"to_{topic}").trigger(**(trigger or {"processingTime": "5 seconds"}))
    if topics.format == "kafka":
        return writer.format("kafka").options(**topics.options).option("topic", topic).start()
    return writer.foreachBatch(lambda batch, batch_id: publish_topic(batch, topics, topic, batch_id, checkpoint)).start()


def stream_to_console(rows: DataFrame, label: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Print a stream, for debugging."""
    writer = rows.writeStream.format("console").queryName(label).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def land_raw_log(lines: DataFrame, topics: Topics, topic: str, landing: str, batch_id: int) -> None:
    """Land every raw line by its arrival day and pass the same lines on to a topic."""
    stamped = lines.select("value", F.to_date("arrival").alias("dt"), F.lit(batch_id).alias("batch_id"))
    (
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch_id").text(landing)
    )
    publish_topic(lines, topics, topic, batch_id, landing)
