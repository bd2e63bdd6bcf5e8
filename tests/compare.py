"""Compare a query with its SQL on the same tables: columns by name, rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return normal(names, result.fetchall())


def spark_rows(rows) -> tuple[list[str], Counter]:
    return normal(rows.columns, [tuple(r) for r in rows.collect()])


def normal(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v
