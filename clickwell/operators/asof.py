"""Dimension values as of a time: each fact gets what was valid when it happened.

The history of a dimension is its change records: key, time, order of changes at one time, and a map
of the columns that a change sets (to null, too). Facts and changes are merged in order of time
and each fact takes the last value before it, so no fact is paired with the versions of its key.
Time is cut into cells and the window is (key, cell): a hot key is spread over as many tasks as it has
cells. What a cell starts with is carried over from one row per cell, not from its changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickwell.functions.cells import cell_start

CELL_MS = 7 * 86_400_000


def as_of(
    facts: DataFrame, history: DataFrame, key: str, at: str, fields: dict[str, str], cell_ms: int = CELL_MS
) -> DataFrame:
    """`facts` with a column per entry of `fields` (new name: name in the history).

    `history` is (id, ts, seq, data map<string,string>); `at` and `ts` are epoch milliseconds. A change
    at the very time of a fact counts; of changes at one time the one with the larger `seq` is the later,
    of equal ones that whose value is larger. A fact without a key or time, or before the first
    change that sets a column, gets null. Every fact comes out once, repeated ones as often.
    """
    taken = {name: f"_set_{i}" for i, name in enumerate(fields)}
    value = lambda source: F.when(
        F.map_contains_key("data", F.lit(source)), F.struct(F.col("data")[source].alias("v")))
    changes = history.where("id IS NOT NULL AND ts IS NOT NULL").select(
        F.col("id").alias("_key"), F.col("ts").alias("_at"), F.col("seq").alias("_seq"),
        *[value(source).alias(taken[name]) for name, source in fields.items()])
    # Changes of one key and time become one, so that no order among them is left open.
    order = lambda c: F.when(F.col(c).isNotNull(), F.struct("_seq", c))
    changes = changes.groupBy("_key", "_at").agg(*[F.max_by(c, order(c)).alias(c) for c in taken.values()])

    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = facts.where(known).select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.struct("*").alias("_fact"))
    rows = _celled(changes, cell_ms).withColumn("_fact", F.lit(None).cast(asked.schema["_fact"].dataType)).unionByName(
        _celled(asked, cell_ms), allowMissingColumns=True)

    carried = {c: f"{c}_before" for c in taken.values()}
    cells = rows.groupBy("_key", "_cell").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in carried])
    earlier = Window.partitionBy("_key").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        F.col("_key").alias("_of"), F.col("_cell").alias("_in"),
        *[F.last(c, ignorenulls=True).over(earlier).alias(before) for c, before in carried.items()])

    # A change goes before the facts of its own time.
    inside = Window.partitionBy("_key", "_cell").orderBy("_at", F.col("_fact").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    valid = rows.select("_key", "_cell", "_fact", *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in carried])
    valid = valid.where("_fact IS NOT NULL").join(
        starts, (F.col("_key") == F.col("_of")) & (F.col("_cell") == F.col("_in")))
    found = valid.select("_fact.*", *[
        F.coalesce(taken[name], carried[taken[name]])["v"].alias(name) for name in fields])
    rest = facts.where(~known).select("*", *[F.lit(None).cast("string").alias(name) for name in fields])
    return found.unionByName(rest)


def _celled(rows: DataFrame, cell_ms: int) -> DataFrame:
    start: Column = cell_start(F.col("_at"), cell_ms)
    return rows.withColumn("_cell", start)
