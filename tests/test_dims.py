"""Dimension tables: creation, column-wise upsert, replay, compaction."""

import uuid

import pytest

from clickwell.operators import dims


@pytest.fixture()
def table(spark, tmp_path):
    schema = f"s{uuid.uuid4().hex[:8]}"
    yield dims.ensure_dim_table(spark, schema, "dim_user", "id,name,age", location=str(tmp_path))
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


def change_rows(spark, *rows):
    return spark.createDataFrame([(data, 0, i) for i, data in enumerate(rows)], "data MAP<STRING,STRING>, ts BIGINT, seq BIGINT")


def image(rows):
    return sorted((tuple(r) for r in rows.collect()), key=str)


COLUMNS = ["id", "name", "age"]


def test_upsert_by_column(spark):
    start = spark.createDataFrame([("1", "a", "3")], "id STRING, name STRING, age STRING")
    upsert = lambda *rows: image(dims.dim_upsert(start, change_rows(spark, *rows), "id", COLUMNS))
    assert upsert({"id": "1", "name": "b"}, {"id": "1", "name": "c"}, {"id": "2", "name": "n"}) == [
        ("1", "c", "3"), ("2", "n", None)
    ]
    assert upsert({"id": "1", "name": None}) == [("1", None, "3")]
    assert upsert({"id": "1", "name": None}, {"id": "1", "age": "4"}) == [("1", None, "4")]
    assert upsert({}) == [("1", "a", "3")]


def test_store(spark, table):
    put = lambda batch, *rows: dims.append_changes(spark, table, change_rows(spark, *rows), batch)
    put(0, {"id": "1", "name": "a", "age": "3"})
    assert image(dims.read_dim(spark, table)) == [("1", "a", "3")]
    put(1, {"id": "1", "name": "b"}, {"id": "1", "name": "c"}, {"id": "2", "name": "n", "junk": "x"})
    want = [("1", "c", "3"), ("2", "n", None)]
    assert image(dims.read_dim(spark, table)) == want
    put(1, {"id": "1", "name": "b"}, {"id": "1", "name": "c"}, {"id": "2", "name": "n"})
    assert image(dims.read_dim(spark, table)) == want
    put(2, {"id": "2", "name": None}, {"name": "no key"})
    want[1] = ("2", None, None)
    assert image(dims.read_dim(spark, table)) == want

    dims.compact_dim(spark, table)
    assert dims._versions(spark, table) == [5]
    assert image(dims.read_dim(spark, table)) == want
    dims.compact_dim(spark, table)
    assert dims._versions(spark, table) == [5]
    put(3, {"id": "3", "age": "9"})
    assert image(dims.read_dim(spark, table)) == [*want, ("3", None, "9")]


def test_crash_during_compaction_leaves_a_right_table(spark, table):
    put = lambda batch, *rows: dims.append_changes(spark, table, change_rows(spark, *rows), batch)
    put(0, {"id": "1", "name": "a"})
    put(1, {"id": "1", "age": "3"})
    folded = dims.fold_versions(spark.table(table), "id", COLUMNS)
    dims._write_version(folded, table, 3)  # the old versions are still there
    assert dims._versions(spark, table) == [0, 2, 3]
    assert image(dims.read_dim(spark, table)) == [("1", "a", "3")]
    dims.compact_dim(spark, table)
    assert dims._versions(spark, table) == [3]
    assert image(dims.read_dim(spark, table)) == [("1", "a", "3")]


def test_new_columns_are_added(spark, table):
    schema = table.split(".")[0]
    dims.append_changes(spark, table, change_rows(spark, {"id": "1", "name": "a"}), 0)
    dims.ensure_dim_table(spark, schema, "dim_user", "id,name,age,city")
    dims.append_changes(spark, table, change_rows(spark, {"id": "1", "city": "x"}), 1)
    row = dims.read_dim(spark, table).first()
    assert (row.id, row.name, row.age, row.city) == ("1", "a", None, "x")


def test_table_is_found_again_by_a_new_session(spark, tmp_path):
    location = str(tmp_path)
    first = dims.ensure_dim_table(spark, "s_again", "dim_x", "id,a", location=location)
    dims.append_changes(spark, first, change_rows(spark, {"id": "1", "a": "v"}), 0)
    spark.sql("DROP SCHEMA s_again CASCADE")
    again = dims.ensure_dim_table(spark, "s_again", "dim_x", "id,a", location=location)
    assert image(dims.read_dim(spark, again)) == [("1", "v")]
    spark.sql("DROP SCHEMA s_again CASCADE")


def test_table_definition(spark):
    table = dims.ensure_dim_table(spark, "s_def", "dim_y", "code,a", sink_pk="code", sink_extend="SALT_BUCKETS = 4")
    assert table == "s_def.DIM_Y" and dims.dim_key(spark, table) == "code"
    assert {f.dataType.simpleString() for f in spark.table(table).schema.fields if not f.name.startswith("_")} == {"string"}
    with pytest.raises(ValueError, match="key"):
        dims.ensure_dim_table(spark, "s_def", "dim_z", "a,b")
    spark.sql("DROP SCHEMA s_def CASCADE")
