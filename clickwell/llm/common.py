"""What the operators share: tables, intermediate results, row numbers, cached word encoding."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.session import run_dir, tune

Query = Callable[[SparkSession, str], DataFrame]


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings; Python workers find this package where the
    driver has it (on a cluster: an install on all nodes, or --py-files)."""
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{held}".rstrip(":")
    # Texts can be long: batches of fewer rows keep the memory of Python workers and buffers low.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors, and
    fixes row numbers. The folder outlives the call, since the result is read lazily."""
    path = run_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A text column with null taken as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_id() -> Column:
    """A number for each row. Stable only once written."""
    return F.monotonically_increasing_id()


def keep_ids(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of `docs` that survive; `decided` has (doc_id, text_sha256, kept), one row per row
    of `docs`.

    Ids none of whose rows is kept are removed by an anti-join: they are the few, and texts are
    not moved when the ids are few enough to be sent along. Where an id is repeated and only some
    of its rows are kept, its texts are looked up too, and equal rows of it become one. A null id
    is an id like any other.
    """
    decided = written(decided, "decided")
    ids = decided.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max("kept").alias("_some"), F.min("kept").alias("_all"))
    ids = written(ids.where("NOT _all"), "ids")
    gone = ids.where("NOT _some").select("_id")
    rest = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    partly = ids.where("_some").select("_id")
    if partly.isEmpty():
        return rest
    whole = rest.join(partly, rest["doc_id"].eqNullSafe(partly["_id"]), "left_anti")
    kept = decided.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_text"))
    twice = rest.join(partly, rest["doc_id"].eqNullSafe(partly["_id"]), "left_semi")
    of_row = F.sha2(F.coalesce(rest["text"], F.lit("")), 256) == kept["_text"]
    twice = twice.join(kept, twice["doc_id"].eqNullSafe(kept["_id"]) & of_row, "left_semi")
    # Of rows equal in both, the one whose other columns come first in order.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = twice.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_rest"))
    return whole.unionByName(one.select(*[F.col(f"_rest.{c}") if c in others else F.col(c) for c in docs.columns]))
