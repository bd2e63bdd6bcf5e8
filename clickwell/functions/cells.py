"""Nearest rows of the same key within a time bound, without one window per key.

A plain `lead`/`lag` over a key puts all rows of that key in one task. Here time is cut
into cells and the window is (key, cell), so a hot key is spread over as many tasks as it
has cells. Rows within the bound of a cell's edge are copied to the neighbouring cell, so
each row still sees every row that can be its neighbour; the copies are dropped after the
window. One shuffle, no join, exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Cell width as a multiple of the bound. At 8 an eighth of the rows is copied per side.
CELL_FACTOR = 8


def cell_start(ts: Column, width: int) -> Column:
    """Start of the cell that holds `ts`, in the unit of `ts`."""
    return ts - F.pmod(ts, F.lit(width))


def with_neighbours(
    rows: DataFrame,
    key: str,
    within: int,
    *,
    ts: str = "ts",
    seq: str = "seq",
    next_fields: dict[str, Column] | None = None,
    prev_fields: dict[str, Column] | None = None,
    cell: int | None = None,
) -> DataFrame:
    """Add `next` and/or `prev`: a struct of the time and the named fields of the immediately
    following or preceding row of the same key in (ts, seq) order, if it is less than `within`
    away; null otherwise. `key` and `ts` must not be null.
    """
    cell = cell or CELL_FACTOR * within
    if cell < within:
        raise ValueError("a cell must be at least as wide as the bound")
    at = F.col(ts)
    own, offset = cell_start(at, cell), F.pmod(at, F.lit(cell))
    nowhere = F.array().cast("array<bigint>")
    homes = [F.array(own)]
    if next_fields is not None:
        homes.append(F.when(offset < within, F.array(own - cell)).otherwise(nowhere))
    if prev_fields is not None:
        homes.append(F.when(offset > cell - within, F.array(own + cell)).otherwise(nowhere))

    spread = rows.withColumn("_cell", F.explode(F.concat(*homes)))
    ordered = Window.partitionBy(key, "_cell").orderBy(ts, seq)
    picked, near = {}, {}
    for name, fields, pick in (("next", next_fields, F.lead), ("prev", prev_fields, F.lag)):
        if fields is not None:
            picked[f"_{name}_at"] = pick(at).over(ordered)
            picked |= {f"_{name}_{field}": pick(item).over(ordered) for field, item in fields.items()}
            found = F.struct(
                F.col(f"_{name}_at").alias(ts), *[F.col(f"_{name}_{field}").alias(field) for field in fields]
            )
            near[name] = F.when(F.abs(F.col(f"_{name}_at") - at) < within, found)

    placed = spread.withColumns(picked).where(F.col("_cell") == cell_start(at, cell))
    return placed.withColumns(near).drop("_cell", *picked)
