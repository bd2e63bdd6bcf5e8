"""Wide order records meet their dimensions, also those that arrive later.

A dimension row and the order that names it come by different ways, so the row may be missing when
the order is worked on. Such a record waits: it is tried again with every micro-batch that brings records and goes out
once all its rows are there, or without them `wait_ms` of event time later. Dimensions are read as
they are then, and only the rows that the records of the batch name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.functions.clock import parse_time
from clickwell.operators import dims, orders
from clickwell.schemas import TOPIC_ORDER_WIDE, WIDE_FACT_COLUMNS
from clickwell.session import drop_folder
from clickwell.sources.topics import Topics, publish_topic
from clickwell.streaming.batches import batch_session, kept
from clickwell.streaming.gate import Marks

DAY_MS = 86_400_000


@dataclass(frozen=True)
class WideDims:
    """The dimension tables of wide order records, as the change job writes them to `schema`. A
    table that no change has created yet is empty."""

    schema: str
    province: str = "dim_base_province"
    user: str = "dim_user_info"
    sku: str = "dim_sku_info"
    spu: str = "dim_spu_info"
    trademark: str = "dim_base_trademark"
    category3: str = "dim_base_category3"

    def read(self, spark: SparkSession, sink_table: str, layout: str, keys: DataFrame) -> DataFrame:
        return dims.read_typed(spark, dims.dim_table_name(self.schema, sink_table), layout, keys)

    def add_to(self, rows: DataFrame) -> DataFrame:
        """`rows` of wide records with the dimensions' columns and `missing`."""
        spark = rows.sparkSession
        sku = self.read(spark, self.sku, "id BIGINT, spu_id BIGINT, tm_id BIGINT, category3_id BIGINT", rows.select("sku_id"))
        with kept(sku) as sku:
            products = orders.sku_with_parts(
                sku, self.read(spark, self.spu, "id BIGINT, spu_name STRING", sku.select("spu_id")),
                self.read(spark, self.trademark, "id BIGINT, tm_name STRING", sku.select("tm_id")),
                self.read(spark, self.category3, "id BIGINT, name STRING", sku.select("category3_id")))
            return orders.wide_and_missing(
                rows,
                self.read(spark, self.province, "id BIGINT, name STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING",
                          rows.select("province_id")),
                self.read(spark, self.user, "id BIGINT, age INT, gender STRING", rows.select("user_id")), products)


@dataclass
class WideDimsStep:
    """Wide records to the wide topic, completed from `tables`; those that lack a row wait below
    `state`. Each batch writes what waits after it, so a replay starts from what its predecessor left."""

    topics: Topics
    tables: WideDims
    state: str
    wait_ms: int = DAY_MS
    topic: str = TOPIC_ORDER_WIDE

    SCHEMA = ", ".join([*(f"{name} {kind}" for name, kind in WIDE_FACT_COLUMNS), "at BIGINT"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, marks = batch_session(batch), Marks(f"{self.state}/marks")
        with kept(batch.withColumn("at", F.unix_millis(parse_time("create_time")))) as fresh:
            newest, n = fresh.agg(F.max("at"), F.count("*")).first()
            mark = max(marks.before(spark, batch_id), newest or 0)
            rows = self.waiting(spark, batch_id).unionByName(fresh)
            # A record without a time has nothing to wait by.
            due = F.coalesce(F.col("at") + self.wait_ms <= mark, F.lit(True))
            # Where only the watermark has moved, nothing is tried again.
            tried = self.tables.add_to(rows).withColumn("ready", (F.size("missing") == 0) | due) if n else rows.withColumn("ready", F.lit(False))
            with kept(tried) as tried:
                done = tried.where("ready").drop("ready", "missing", "at")
                publish_topic(done.select(F.to_json(F.struct("*")).alias("value")), self.topics, self.topic, batch_id, self.state)
                tried.where("NOT ready").select(*rows.columns).write.mode("overwrite").parquet(self.folder(batch_id))
        marks.store(spark, batch_id, mark)
        drop_folder(spark, self.folder(batch_id - 2))

    def folder(self, batch_id: int) -> str:
        return f"{self.state}/waiting/batch_id={batch_id}"

    def waiting(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What waited after the batch before."""
        if batch_id == 0:
            return spark.createDataFrame([], self.SCHEMA)
        return spark.read.schema(self.SCHEMA).parquet(self.folder(batch_id - 1))
