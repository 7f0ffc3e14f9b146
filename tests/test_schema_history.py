"""Schemas over batches."""

from __future__ import annotations

from plumbline.operators.schema_history import read_schema_snapshots, schema_changes, write_schema_snapshot
from plumbline.session import work_path


def changes(spark, schemas, path=None):
    path = path or work_path(spark, "t")
    for batch, schema in schemas.items():
        write_schema_snapshot(spark.createDataFrame([], schema), batch, path)
    found = schema_changes(read_schema_snapshots(spark, path)).orderBy("batch", "column").collect()
    return [(r["batch"], r["version"], r["column"], r["change"], r["from_type"], r["to_type"]) for r in found]


def test_what_changed_with_which_batch(spark):
    """Batches need not be numbered without gaps; a schema that comes back is a new version."""
    assert changes(spark, {0: "a int, b string", 3: "a int, b string", 4: "a int, c date, b string", 9: "a bigint, b string", 10: "b string, a bigint"}) == [
        (4, 2, "c", "appeared", None, "date"),
        (9, 3, "a", "retyped", "int", "bigint"),
        (9, 3, "c", "vanished", "date", None),
        (10, 4, "a", "moved", "bigint", "bigint"),
        (10, 4, "b", "moved", "string", "string"),
    ]


def test_nested_types_and_replaced_batches(spark):
    path = work_path(spark, "t")
    nested = {0: "s struct<x: int>, m map<string, int>", 1: "s struct<x: int, y: int>, m map<string, int>"}
    assert changes(spark, nested, path) == [(1, 2, "s", "retyped", "struct<x:int>", "struct<x:int,y:int>")]
    assert changes(spark, {1: nested[0]}, path) == []


def test_first_batch_and_batches_without_columns(spark):
    assert changes(spark, {5: "a int"}) == []
    path = work_path(spark, "t")
    write_schema_snapshot(spark.createDataFrame([], "a int"), 0, path)
    write_schema_snapshot(spark.range(3).select(), 1, path)
    assert changes(spark, {2: "a int"}, path) == [(1, 2, "a", "vanished", "int", None), (2, 3, "a", "appeared", None, "int")]
