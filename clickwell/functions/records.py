"""Working with open JSON records without losing fields nobody declared.

An open record is a `map<string, variant>`: each value keeps its JSON type, so a record
can be parsed, changed in one place and written back whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickwell.schemas import OPEN_RECORD


def parse_json(value: str | Column, schema: str | T.StructType, strict: bool = False) -> Column:
    """Parse JSON text. Bad text gives nulls, or fails the job when `strict`."""
    return F.from_json(value, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def with_once(rows: DataFrame, name: str, item: Column) -> DataFrame:
    """Add a column that is costly to compute and read several times later.

    The optimizer would copy the expression into every filter and projection that reads it and
    so parse the same text again and again. It does not move them past a generator, hence the
    explode of a one-element array.
    """
    return rows.select("*", F.explode(F.array(item)).alias(name))


def open_record(value: str | Column, strict: bool = False) -> Column:
    return parse_json(value, OPEN_RECORD, strict)


def text_of(item: Column) -> Column:
    """A variant as text; JSON null and missing values are null."""
    return F.try_variant_get(item, "$", "string")


def object_of(item: Column) -> Column:
    """A variant as an open record; null when it is not an object."""
    return F.try_variant_get(item, "$", OPEN_RECORD)


def variant_of(value: Column) -> Column:
    return value.cast("variant")


def put(record: Column, **entries: Column) -> Column:
    """Set entries of an open record, replacing any of the same name."""
    names = list(entries)
    kept = F.map_filter(record, lambda key, _: ~key.isin(names))
    added = F.create_map(*[part for name, item in entries.items() for part in (F.lit(name), item)])
    return F.map_concat(kept, added)


def is_blank(text: str | Column) -> Column:
    """Null or empty text."""
    return F.coalesce(F.length(text), F.lit(0)) == 0
