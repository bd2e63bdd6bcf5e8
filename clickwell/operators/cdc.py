"""Change records: validity, normalisation, configuration-driven routing and projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickwell.functions import records
from clickwell.schemas import MIN_COLUMNS, SINK_DIMENSION, SINK_FACT, SNAPSHOT_INSERT


def parse_cdc(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Add `table`, `type`, `ts`, `data` and the whole open `record` to the `value` text."""
    record = F.col("record")
    parsed = records.with_once(lines, "record", records.open_record("value", strict))
    parsed = records.with_once(parsed, "data", records.object_of(record["data"]))
    return parsed.withColumns({
        "table": records.text_of(record["table"]),
        "type": records.text_of(record["type"]),
        "ts": records.text_of(record["ts"]).try_cast("bigint"),
    })


def fault(min_columns: int = MIN_COLUMNS):
    """Why a change cannot be used, or null: it needs a table, an operation and a `data` object
    with at least `min_columns` columns.

    The text of a JSON object is longer than three characters exactly when it has a key, so
    the length test on the text of `data` is the width test with a bound of one.
    """
    return (
        F.when(F.col("record").isNull(), "malformed")
        .when(F.col("table").isNull(), "no_table")
        .when(F.col("type").isNull(), "no_type")
        .when(F.col("data").isNull(), "no_data")
        .when(F.size("data") < max(min_columns, 1), "too_narrow")
    )


def cdc_valid(changes: DataFrame, min_columns: int = MIN_COLUMNS) -> DataFrame:
    """Records with a table, an operation and a wide enough `data` object."""
    return changes.where(fault(min_columns).isNull())


def cdc_rejects(changes: DataFrame, min_columns: int = MIN_COLUMNS) -> DataFrame:
    """The complement of `cdc_valid`, with the reason."""
    return changes.withColumn("reason", fault(min_columns)).where("reason IS NOT NULL")


def cdc_normalize(changes: DataFrame) -> DataFrame:
    """Rows of a snapshot load count as inserts."""
    kind = F.when(F.col("type") == SNAPSHOT_INSERT, "insert").otherwise(F.col("type"))
    return changes.withColumn("type", kind)


def route_table(config: DataFrame) -> DataFrame:
    """Routing configuration, one row per (source_table, operate_type): the last row wins
    by `row_no`. `keep` is the parsed column list, null when every column is kept."""
    fields = ["sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]
    latest = config.groupBy("source_table", "operate_type").agg(
        F.max_by(F.struct(*fields), "row_no").alias("c")
    )
    keep = F.when(
        ~records.is_blank("sink_columns"), F.array_remove(F.split("sink_columns", ","), "")
    )
    target = (
        F.when(F.upper("sink_type") == SINK_DIMENSION, "dim")
        .when(F.upper("sink_type") == SINK_FACT, "fact")
        .otherwise("unsupported_sink")
    )
    return latest.select("source_table", "operate_type", "c.*").withColumns(
        {"keep": keep, "target": target}
    )


def cdc_classify(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach the route to each change in one pass. `target` is 'fact' or 'dim', else the
    reason why the change goes nowhere: 'no_config' or 'unsupported_sink'."""
    looked_up = changes.join(
        routes,
        (F.col("table") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        "left",
    )
    return looked_up.withColumn("target", F.coalesce("target", F.lit("no_config"))).drop(
        "source_table", "operate_type", "sink_type"
    )


def cdc_route(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Changes that have a destination."""
    return cdc_classify(changes, routes).where(F.col("target").isin("fact", "dim"))


def cdc_unrouted(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Changes without one, with the reason."""
    classified = cdc_classify(changes, routes)
    return classified.where(~F.col("target").isin("fact", "dim")).withColumnRenamed("target", "reason")


def cdc_facts(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("target") == "fact")


def cdc_dims(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("target") == "dim")


def cdc_project(routed: DataFrame) -> DataFrame:
    """Keep only the configured columns of `data`."""
    kept = F.map_filter("data", lambda name, _: F.array_contains("keep", name))
    return routed.withColumn("data", F.when(F.col("keep").isNull(), F.col("data")).otherwise(kept))


def fact_text():
    """The whole record as text, with the normalised type, the projected data and the
    destination put in."""
    return F.to_json(records.put(
        F.col("record"),
        type=records.variant_of(F.col("type")),
        data=F.to_variant_object("data"),
        sink_table=records.variant_of(F.col("sink_table")),
    ))


def dim_entries():
    """The projected data as a map of text: dimension columns are all text."""
    return F.transform_values("data", lambda _, item: records.text_of(item))


def fact_messages(projected: DataFrame) -> DataFrame:
    """(topic, value) of the fact changes."""
    return projected.select(F.col("sink_table").alias("topic"), fact_text().alias("value"))


def dim_changes(projected: DataFrame) -> DataFrame:
    """(sink_table, data, ts, offset) of the dimension changes that set anything."""
    order = [name for name in ("ts", "seq", "offset") if name in projected.columns]
    return projected.where(F.size("data") > 0).select("sink_table", dim_entries().alias("data"), *order)
