"""Streaming steps that run set-based on each micro-batch (`foreachBatch`).

They are used where one input has several outputs, or where the batch form is exact under
hot keys and a per-key state function is not. Each step is a callable (batch, batch_id) and
writes under its batch id: a topic shows a batch whole and once, also when it is replayed, and
tables of a job's own are replaced. Micro-batches are bounded by the limits given to the source.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.functions import records
from clickwell.operators import cdc, dims, logs, visits
from clickwell.schemas import BOUNCE_MS, DEFAULT_KEY, MIN_COLUMNS, ROUTE_CONFIG, TOPIC_DISPLAY, TOPIC_PAGE, TOPIC_START, TOPIC_USER_JUMP
from clickwell.session import drop_folder, files_at
from clickwell.sources.tables import read_route_config
from clickwell.sources.topics import Topics, publish_routed, publish_topic

TOPIC_LOG_REJECTS = "QUARANTINE_LOG"
TOPIC_DB_REJECTS = "QUARANTINE_DB"
TOPIC_LATE = "QUARANTINE_LATE"
TOPIC_IN_TIME = "IN_TIME_PAGE"


@contextmanager
def kept(rows: DataFrame):
    """Hold a result that several writes share; lost blocks are recomputed from the source."""
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def batch_session(batch: DataFrame) -> SparkSession:
    """The session of a micro-batch, with the adaptive execution that streams switch off."""
    spark = batch.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


@dataclass
class FirstVisits:
    """First day of each visitor, across micro-batches: a folder with one partition per batch
    that holds only the visitors new in it, folded into one every `fold_every` batches.

    The few visitors of a batch are matched against it by a scan; it is not shuffled as long
    as they fit a broadcast. A stored day is never changed.
    """

    path: str
    fold_every: int = 500

    SCHEMA = "mid STRING, first_day STRING, batch_id BIGINT"

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/epoch={batch_id // self.fold_every}"

    def _before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        reader, folder = spark.read.schema(self.SCHEMA), self._folder(batch_id)
        if batch_id == 0:
            return spark.createDataFrame([], self.SCHEMA)
        if batch_id % self.fold_every == 0:
            last = reader.parquet(self._folder(batch_id - 1)).drop("batch_id")
            last.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id - 1}")
            drop_folder(spark, self._folder(batch_id - 1 - self.fold_every))
        return reader.parquet(folder).where(F.col("batch_id") < batch_id)

    @contextmanager
    def resolved(self, log: DataFrame, batch_id: int):
        """First days of the visitors of a batch; those not seen before are stored."""
        with kept(logs.first_claims(log)) as claims:
            claims.count()  # from here on the optimizer knows its size
            earlier = self._before(log.sparkSession, batch_id).select("mid", F.col("first_day").alias("stored"))
            with kept(earlier.join(claims.select("mid"), "mid")) as hits:
                firsts = claims.join(hits, "mid", "left")
                new = firsts.where("stored IS NULL").select("mid", "first_day")
                new.write.mode("overwrite").parquet(f"{self._folder(batch_id)}/batch_id={batch_id}")
                yield firsts.select("mid", F.coalesce("stored", "first_day").alias("first_day"))


@dataclass
class LogStep:
    """Raw log lines to start, page and exposure topics; bad lines to quarantine."""

    topics: Topics
    first_visits: FirstVisits

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_session(batch)
        with kept(logs.parse_log(batch.select("value", "offset"))) as parsed:
            log = logs.log_valid(parsed)
            with self.first_visits.resolved(log, batch_id) as firsts, kept(
                logs.repair_flags(log, firsts)
            ) as repaired:
                publish_topic(logs.start_records(repaired), self.topics, TOPIC_START, batch_id, self.first_visits.path)
                publish_topic(logs.page_records(repaired), self.topics, TOPIC_PAGE, batch_id, self.first_visits.path)
                shown = logs.display_records(repaired).select(F.to_json("item").alias("value"))
                publish_topic(shown, self.topics, TOPIC_DISPLAY, batch_id, self.first_visits.path)
            publish_topic(logs.log_rejects(parsed), self.topics, TOPIC_LOG_REJECTS, batch_id, self.first_visits.path)


@dataclass
class ChangeStep:
    """Change records to fact topics and dimension tables, by a configuration that is read
    again for every micro-batch; the rest to quarantine.

    The configuration of a batch is written below `snapshots` before it is used, so all its uses
    and a replay of the batch see the same one. Changes of one key apply in order of arrival,
    within a batch and across batches.
    """

    topics: Topics
    load_config: Callable[[SparkSession], DataFrame]
    schema: str
    snapshots: str
    location: str | None = None
    min_columns: int = MIN_COLUMNS
    compact_every: int = 100

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        routes = cdc.route_table(self.config_of(spark, batch_id))
        # A route that keeps some columns but not the key cannot make a table: its changes are set aside.
        own_key = F.coalesce(F.nullif("sink_pk", F.lit("")), F.lit(DEFAULT_KEY))
        keeps_key = records.is_blank("sink_columns") | F.array_contains(F.split("sink_columns", ","), own_key)
        routes = routes.withColumn("target", F.when(
            (F.col("target") == "dim") & ~keeps_key, "bad_config").otherwise(F.col("target")))
        parsed = cdc.cdc_normalize(cdc.parse_cdc(batch.select("value", "offset")))
        with_fault = parsed.withColumn("fault", cdc.fault(self.min_columns))
        projected = cdc.cdc_project(cdc.cdc_classify(with_fault, routes))
        target = F.coalesce("fault", "target")
        key = F.coalesce(F.nullif("sink_pk", F.lit("")), F.lit(DEFAULT_KEY))
        keyless = (target == "dim") & (F.size("data") > 0) & records.text_of(F.try_element_at("data", key)).isNull()
        target = F.when(keyless, "no_key").otherwise(target)
        outcome = projected.select(
            target.alias("target"), "sink_table", "ts", "offset",
            F.when(target == "fact", cdc.fact_text()).otherwise(F.col("value")).alias("value"),
            F.when(target == "dim", cdc.dim_entries()).alias("data"),
        )
        with kept(outcome) as outcome:
            changes = outcome.where("target = 'dim' AND size(data) > 0")
            for sink_table, table in self.dim_tables(spark, routes, changes).items():
                own = changes.where(F.col("sink_table") == sink_table)
                dims.append_changes(spark, table, own, batch_id, order=("offset",))
                if batch_id % self.compact_every == self.compact_every - 1:
                    dims.compact_dim(spark, table)
            rejected = outcome.where("target NOT IN ('fact', 'dim')")
            publish_topic(rejected, self.topics, TOPIC_DB_REJECTS, batch_id, self.snapshots)
            facts = outcome.where("target = 'fact'").withColumnRenamed("sink_table", "topic")
            publish_routed(facts, self.topics, batch_id, self.snapshots)

    def config_of(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The configuration as it was when the batch was first worked on."""
        path = f"{self.snapshots}/batch_id={batch_id}"
        files, done = files_at(spark, f"{path}/_SUCCESS")
        if not files.exists(done):
            read_route_config(self.load_config(spark)).write.mode("overwrite").parquet(path)
        drop_folder(spark, f"{self.snapshots}/batch_id={batch_id - 2}")
        return spark.read.schema(f"{ROUTE_CONFIG}, row_no BIGINT").parquet(path)

    def dim_tables(self, spark: SparkSession, routes: DataFrame, changes: DataFrame) -> dict[str, str]:
        """The dimension tables that a batch changes, created on demand: sink table to table
        name. Columns of all operations of a sink table are put together; where an operation
        keeps all columns, those seen in the batch are added."""
        seen = changes.select("sink_table", F.explode(F.map_keys("data")).alias("name")).groupBy("sink_table").agg(
            F.sort_array(F.collect_set("name")).alias("seen"))
        wanted = routes.where("target = 'dim'").groupBy("sink_table").agg(
            F.flatten(F.collect_list(F.split("sink_columns", ","))).alias("listed"),
            F.max(records.is_blank("sink_columns")).alias("whole"),
            F.max("sink_pk").alias("pk"), F.max("sink_extend").alias("extend"),
        ).join(seen, "sink_table").select(
            "sink_table", F.array_join(F.array_distinct(F.when(
                F.col("whole"), F.concat("listed", "seen")).otherwise(F.col("listed"))), ","), "pk", "extend")
        return {
            sink: dims.ensure_dim_table(spark, self.schema, sink, columns, pk, extend, self.location)
            for sink, columns, pk, extend in wanted.collect()
        }


@dataclass
class JumpStep:
    """Page records to bounces and in-time follow-ups, both from one pass.

    A record is decided once the watermark is `within_ms` past it. The undecided ones, and
    those before them that may still be needed, are carried to the next micro-batch: about
    twice `within_ms` of log. Records behind the watermark go to quarantine.
    """

    topics: Topics
    carry: str
    within_ms: int = BOUNCE_MS
    delay_ms: int = 0
    cell_ms: int | None = None

    FIELDS = ["value", "mid", "page_id", "last_page_id", "ts", "seq"]
    SCHEMA = """
        value STRING, mid STRING, page_id STRING, last_page_id STRING, ts BIGINT,
        seq STRUCT<batch: BIGINT, offset: BIGINT>, watermark BIGINT
    """

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        parsed = logs.parse_log(batch.select("value", "offset"))
        publish_topic(logs.log_rejects(parsed), self.topics, TOPIC_LOG_REJECTS, f"{batch_id}-jump", self.carry)
        fresh = logs.log_valid(parsed)
        arrival = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "offset")
        fresh = fresh.withColumn("seq", arrival).select(*self.FIELDS)
        with kept(fresh) as fresh:
            carried, before = self.carried(spark, batch_id)
            newest = fresh.agg(F.max("ts")).first()[0]
            known = [t for t in (before, None if newest is None else newest - self.delay_ms) if t is not None]
            if not known:
                carried.write.mode("overwrite").parquet(f"{self.carry}/batch_id={batch_id}")
                return
            mark = max(known)
            is_late = F.lit(False) if before is None else F.col("ts") < before
            publish_topic(fresh.where(is_late), self.topics, TOPIC_LATE, batch_id, self.carry)

            rows = carried.select(*self.FIELDS).unionByName(fresh.where(~is_late))
            edge = mark - self.within_ms
            decided = F.col("ts") <= edge
            if before is not None:
                decided = decided & (F.col("ts") > before - self.within_ms)
            with kept(visits.jump_split(rows, self.within_ms, self.cell_ms).where(decided)) as split:
                publish_topic(split.where("is_bounce"), self.topics, TOPIC_USER_JUMP, batch_id, self.carry)
                publish_topic(split.where("is_follow_up"), self.topics, TOPIC_IN_TIME, batch_id, self.carry)
            (
                rows.where(F.col("ts") > edge - self.within_ms).withColumn("watermark", F.lit(mark))
                .write.mode("overwrite").parquet(f"{self.carry}/batch_id={batch_id}")
            )
        # A replay of this batch needs its predecessor only.
        drop_folder(spark, f"{self.carry}/batch_id={batch_id - 2}")

    def carried(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, int | None]:
        if batch_id == 0:
            return spark.createDataFrame([], self.SCHEMA), None
        rows = spark.read.schema(self.SCHEMA).parquet(f"{self.carry}/batch_id={batch_id - 1}")
        return rows, rows.agg(F.max("watermark")).first()[0]
