"""Dimension tables: created on demand, upserted column by column.

A change carries some columns of a row: they replace the stored ones (a null that is present
included), the others stay. A dimension table holds text columns plus `_present`, the columns
a row sets, and is partitioned by `_version`. Each micro-batch adds one small partition with
one row per changed key, so an upsert costs as much as its batch and not as much as the table;
replaying a batch overwrites its own partition. Reading folds the versions; `compact_dim`
does it ahead of time. Batch n is version 2n, a compaction up to it is version 2n + 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickwell.schemas import DEFAULT_KEY
from clickwell.session import drop_folder, files_at


def _fold(rows: DataFrame, pk: str, columns: list[str], value, order) -> DataFrame:
    """One row per key: the latest value of each column, `value(c)`, by `order(c)`, which is
    null on rows that do not set c. Partial aggregation takes the weight off hot keys."""
    others = [name for name in columns if name != pk]
    latest = [F.max_by(value(name), order(name)).alias(name) for name in others]
    was_set = [
        F.when(F.count(order(name)) > 0, F.lit(name)).alias(f"_set_{name}") for name in others
    ]
    folded = rows.where(F.col(pk).isNotNull()).groupBy(pk).agg(*latest, *was_set)
    present = F.array_compact(F.array(F.lit(pk), *[F.col(f"_set_{name}") for name in others]))
    return folded.select(*columns, present.alias("_present"))


def fold_changes(changes: DataFrame, pk: str, columns: list[str], order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """Change rows (`data` map of text, order columns) to one row per key with `_present`."""
    at = F.struct(*order)
    keyed = changes.withColumn(pk, F.col("data")[pk]) if pk not in changes.columns else changes
    return _fold(
        keyed, pk, columns,
        value=lambda name: F.col("data")[name],
        order=lambda name: F.when(F.map_contains_key("data", F.lit(name)), at),
    )


def fold_versions(stored: DataFrame, pk: str, columns: list[str]) -> DataFrame:
    """Versioned rows to the present image, still with `_present`."""
    return _fold(
        stored, pk, columns,
        value=F.col,
        order=lambda name: F.when(F.array_contains("_present", F.lit(name)), F.col("_version")),
    )


def dim_upsert(
    current: DataFrame, changes: DataFrame, pk: str, columns: list[str], order: tuple[str, ...] = ("ts", "seq")
) -> DataFrame:
    """The table after the changes, as plain columns. `current` is its image before them."""
    before = current.select(
        *columns, F.array(*[F.lit(name) for name in columns]).alias("_present"), F.lit(0).alias("_version")
    )
    after = fold_changes(changes, pk, columns, order).withColumn("_version", F.lit(1))
    return fold_versions(before.unionByName(after), pk, columns).select(*columns)


def dim_table_name(schema: str, sink_table: str) -> str:
    return f"{schema}.{sink_table.upper()}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_dim_table(
    spark: SparkSession, schema: str, sink_table: str, sink_columns: str | None,
    sink_pk: str | None = None, sink_extend: str | None = None, location: str | None = None,
) -> str:
    """Create the table unless it exists; all columns are text. Columns the configuration has
    gained since are added. Key and extension clause are kept as table properties."""
    columns = [name for name in (sink_columns or "").split(",") if name]
    pk = sink_pk or DEFAULT_KEY
    if pk not in columns:
        raise ValueError(f"dimension {sink_table}: key {pk!r} is not among its columns {columns}")
    table = dim_table_name(schema, sink_table)
    at = (lambda path: f" LOCATION {_literal(path)}") if location else (lambda path: "")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}{at(f'{location}/_schema')}")
    known = spark.catalog.tableExists(table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ("
        + ", ".join(f"{_quoted(name)} STRING" for name in columns)
        + ", _present ARRAY<STRING>, _version BIGINT) USING parquet PARTITIONED BY (_version)"
        + at(f"{location}/{sink_table.upper()}")
        + f" TBLPROPERTIES ('sink_pk' = {_literal(pk)}, 'sink_extend' = {_literal(sink_extend or '')})"
    )
    if not known and location:
        _register_versions(spark, table, f"{location}/{sink_table.upper()}")
    if known:
        missing = [name for name in columns if name not in spark.table(table).columns]
        if missing:
            spark.sql(
                f"ALTER TABLE {table} ADD COLUMNS ("
                + ", ".join(f"{_quoted(name)} STRING" for name in missing) + ")"
            )
    return table


def dim_key(spark: SparkSession, table: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {table} ('sink_pk')").first()["value"]


def dim_columns(spark: SparkSession, table: str) -> list[str]:
    return [name for name in spark.table(table).columns if not name.startswith("_")]


def _versions(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _register_versions(spark: SparkSession, table: str, location: str) -> None:
    """Versions an earlier session wrote to the folder; unfinished ones are left out."""
    files, folder = files_at(spark, location)
    files.mkdirs(folder)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("_version=") and files.exists(files_at(spark, f"{location}/{name}/_SUCCESS")[1]):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (_version = {int(name.split('=')[1])})")


def _version_path(spark: SparkSession, table: str, version: int) -> str:
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    return f"{place}/_version={version}"


def _write_version(rows: DataFrame, table: str, version: int) -> None:
    """Write one version, then make it visible."""
    spark = rows.sparkSession
    stored = [name for name in spark.table(table).columns if name != "_version"]
    rows.select(*stored).write.mode("overwrite").parquet(_version_path(spark, table, version))
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (_version = {version})")
    spark.catalog.refreshTable(table)


def _drop_version(spark: SparkSession, table: str, version: int) -> None:
    path = _version_path(spark, table, version)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (_version = {version})")
    drop_folder(spark, path)
    spark.catalog.refreshTable(table)


def append_changes(
    spark: SparkSession, table: str, changes: DataFrame, batch_id: int, order: tuple[str, ...] = ("ts", "seq")
) -> None:
    """Upsert one micro-batch. Doing the same batch again changes nothing."""
    folded = fold_changes(changes, dim_key(spark, table), dim_columns(spark, table), order)
    _write_version(folded, table, 2 * batch_id)


def read_dim(spark: SparkSession, table: str) -> DataFrame:
    """The present image of a dimension table."""
    columns = dim_columns(spark, table)
    return fold_versions(spark.table(table), dim_key(spark, table), columns).select(*columns)


def read_typed(spark: SparkSession, table: str, layout: str, keys: DataFrame | None = None) -> DataFrame:
    """The present image of a dimension table with the columns and types of `layout`; text that does
    not fit its type is null, and so are columns that the table lacks. With `keys` (one column),
    only rows of these keys are folded. A table that does not exist is empty."""
    fields = T.StructType.fromDDL(layout).fields
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], layout)
    spark.catalog.refreshTable(table)  # another job may have written to it
    pk, columns, stored = dim_key(spark, table), dim_columns(spark, table), spark.table(table)
    if keys is not None:
        wanted = keys.select(F.col(keys.columns[0]).cast("string").alias("_key"))
        stored = stored.join(wanted, F.col(pk) == F.col("_key"), "left_semi")
    image = fold_versions(stored, pk, columns)
    return image.select(*[
        (F.col(field.name) if field.name in columns else F.lit(None)).try_cast(field.dataType).alias(field.name)
        for field in fields
    ])


def compact_dim(spark: SparkSession, table: str) -> None:
    """Fold all versions into one. The folded version is complete before the old ones go, and
    it outranks them, so a crash in between leaves a right table."""
    versions = _versions(spark, table)
    if not versions or len(versions) == 1 and versions[0] % 2:
        return
    newest = versions[-1]
    if newest % 2 == 0:
        image = fold_versions(spark.table(table), dim_key(spark, table), dim_columns(spark, table))
        _write_version(image, table, newest + 1)
        newest += 1
    for version in versions:
        if version < newest:
            _drop_version(spark, table, version)
