"""Merged snapshots against the profile of all rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators.profile import profile
from plumbline.operators.snapshots import merge_snapshots, profile_of_snapshot, sketch_error, snapshot, snapshot_drift
from plumbline.session import work_path
from plumbline.sources.layers import write_layer

EXACT = ["position", "column", "data_type", "total_rows", "null_count", "null_rate", "min", "max", "mean", "stddev", "first_day", "last_day"]


@pytest.fixture
def rows(spark):
    """Five batches, one of which is one row and one of which has only NULL; all kinds of columns."""
    return spark.range(4000).selectExpr(
        "CASE WHEN id = 7 THEN 3 WHEN id % 10 = 0 THEN 4 ELSE id % 3 END AS batch",
        "IF(id % 10 = 0, NULL, 1e9 + id % 7) AS x",
        "IF(id % 4 = 0, NULL, concat('v', id)) AS `t.u`",
        "CAST(id % 5 AS tinyint) AS b",
        "CAST(id AS decimal(20, 2)) AS d",
        "date_add(DATE'2024-01-01', CAST(id % 30 AS int)) AS day",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS int)) AS at",
        "array(id % 3) AS a",
        "map('k', id) AS m",
    )


def test_five_merged_batches_equal_the_whole(spark, rows):
    """Means near 1e9 with a spread of 2 lose nothing, whichever way the parts are grouped."""
    parts = write_layer(snapshot(rows, "batch"), work_path(spark, "parts"))
    expected = sorted(profile(rows.drop("batch"), top_k=0).select(*EXACT).collect())
    for merged in (merge_snapshots(parts), merge_snapshots(merge_snapshots(parts.withColumn("half", F.col("batch") % 2), "half").drop("half")), merge_snapshots(snapshot(rows.drop("batch")))):
        assert sorted(profile_of_snapshot(merged).select(*EXACT).collect()) == expected
    by_batch = profile_of_snapshot(merge_snapshots(parts, "batch"), "batch").filter("batch = 3 AND column = 'x'").first()
    assert (by_batch["total_rows"], by_batch["mean"], by_batch["stddev"]) == (1, 1e9, None)


def test_sketches_merge_within_their_error(spark, rows):
    merged = profile_of_snapshot(merge_snapshots(snapshot(rows, "batch")))
    exact = {r["column"]: r["distinct_count"] for r in profile(rows.drop("batch"), top_k=0).collect()}
    for r in merged.collect():
        if exact[r["column"]] is None:
            assert r["distinct_count"] is None
        else:
            assert abs(r["distinct_count"] - exact[r["column"]]) <= sketch_error() * exact[r["column"]], r


def test_a_snapshot_is_one_pass_of_one_row_per_group(spark, rows):
    plan = snapshot(rows, "batch")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_drift_reads_snapshots(spark, rows):
    found = {(r["batch"], r["column"]): r for r in snapshot_drift(snapshot(rows, "batch"), "batch").collect()}
    last, first = found[4, "x"], found[0, "x"]
    assert (last["null_rate"], last["null_rate_change"], last["previous_rows"]) == (1.0, 1.0, 1)
    assert first["previous_rows"] is None and first["shift"] is None and math.isclose(first["mean"], 1e9, abs_tol=9)
    assert found[0, "m"]["null_rate"] == 0.0


def test_empty(spark, rows):
    empty = rows.limit(0)
    assert snapshot(empty, "batch").count() == 0
    assert merge_snapshots(snapshot(empty.drop("batch"))).count() == 0
