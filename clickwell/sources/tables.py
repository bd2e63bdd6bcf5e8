"""Table sources: queries over JDBC, the routing configuration, test and dimension tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.schemas import ROUTE_CONFIG


def jdbc_options(
    url: str, query: str, split_by: str | None = None, lower: object = None, upper: object = None,
    splits: int = 1, **options: str,
) -> dict[str, str]:
    """Reader options of a query. With `split_by` (a number, date or timestamp column of it) and
    its bounds, `splits` tasks read a range each; rows beyond the bounds go to the outer ranges."""
    if split_by is None:
        return {"url": url, "query": query, **options}
    if lower is None or upper is None or splits < 1:
        raise ValueError("a split query needs bounds and at least one split")
    return {
        "url": url, "dbtable": f"({query}) t", "partitionColumn": split_by, "lowerBound": str(lower),
        "upperBound": str(upper), "numPartitions": str(splits), **options,
    }


def camel_case(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def camel_columns(rows: DataFrame) -> DataFrame:
    """snake_case column names to camelCase."""
    return rows.withColumnsRenamed({name: camel_case(name) for name in rows.columns})


def query_list(spark: SparkSession, url: str, query: str, to_camel: bool = False, **options) -> DataFrame:
    """Rows of a query, with all the columns it returns."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()
    return camel_columns(rows) if to_camel else rows


def local_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few rows as a local relation, whose exact size the optimizer knows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    arrow = pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema=schema)


def read_route_config(config: DataFrame) -> DataFrame:
    """The routing configuration; `row_no` keeps its row order. An empty one is an error."""
    names = [part.split()[0] for part in ROUTE_CONFIG.split(",")]
    if "row_no" not in config.columns:
        config = config.withColumn("row_no", F.monotonically_increasing_id())
    config = config.select(*names, F.col("row_no").cast("bigint").alias("row_no"))
    if config.isEmpty():
        raise ValueError("the routing configuration is empty")
    return config


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
