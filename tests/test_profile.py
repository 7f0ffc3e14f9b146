from __future__ import annotations

import collections
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from plumbline import (
    check_suggested_rules,
    distinct_counts,
    good_rules,
    profile,
    read_rules,
    rules_from_frame,
    suggest_rules,
    top_values,
    write_rules,
)
from plumbline.operators.checks import run_suite
from plumbline.session import work_path
from plumbline.sources.bridge import clean_orders, dirty_orders, read_table


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_profile_equals_one_query_per_statistic(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir)
    found = by_column(profile(orders))
    assert list(found) and set(found) == set(orders.columns)
    for name in orders.columns:
        row, column = found[name], F.col(name)
        assert row["total_rows"] == orders.count()
        assert row["null_count"] == orders.filter(column.isNull()).count()
        assert row["distinct_count"] == orders.select(name).distinct().count()
    amounts = [r[0] for r in orders.select("order_amount").collect()]
    assert found["order_amount"]["min"] == min(amounts)
    assert found["order_amount"]["highest"] == max(amounts)
    assert abs(found["order_amount"]["mean"] - sum(amounts) / len(amounts)) < 0.006
    assert found["payment_method"]["null_rate"] == 0.15


def test_small_cases(spark):
    rows = [("a", 0.0, 1, dt.date(2024, 1, 2)), ("b", 0.0, None, None), (None, 0.0, 3, dt.date(2024, 1, 1)), (None, 0.0, 3, None), ("b", 0.0, 3, None), ("c", 0.0, 3, None)]
    df = spark.createDataFrame(rows, "t string, z double, n bigint, d date").withColumn("ingested_at", F.current_timestamp())
    found = by_column(profile(df, top_k=2))
    assert set(found) == {"t", "z", "n", "d"}
    assert found["t"]["distinct_count"] == 4 and found["t"]["top_values"] == ["b", None]
    assert found["z"]["min"] == found["z"]["max"] == found["z"]["stddev"] == 0.0
    assert found["n"]["distinct_count"] == 3 and found["n"]["null_rate"] == 0.1667
    assert (found["d"]["first_day"], found["d"]["last_day"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert found["d"]["min"] is None and found["z"]["top_values"] is None
    ranked = [(r["rank"], r["value"], r["rows"]) for r in top_values(df, 3).orderBy("rank").collect()]
    assert ranked == [(1, "b", 2), (2, None, 2), (3, "a", 1)]


def test_one_row_and_no_rows(spark):
    one = by_column(profile(spark.createDataFrame([(1.5, "x")], "x double, t string")))
    assert one["x"]["stddev"] is None and one["x"]["mean"] == 1.5
    none = by_column(profile(spark.createDataFrame([], "x double, t string")))
    assert none["x"]["total_rows"] == 0 and none["x"]["null_rate"] is None
    assert none["t"]["distinct_count"] == 0 and none["t"]["top_values"] is None


def test_columns_with_odd_names_and_huge_values(spark):
    df = spark.createDataFrame([(1e300, "v"), (float("inf"), "w")], "`a.b` double, `c d` string")
    df = df.withColumn("it's {x} \\ `q`", F.lit("v"))
    found = by_column(profile(df))
    assert found["it's {x} \\ `q`"]["top_values"] == ["v"]
    assert found["a.b"]["highest"] == float("inf") and found["a.b"]["min"] == 1e300
    assert found["c d"]["distinct_count"] == 2


def test_nested_columns(spark):
    df = spark.sql("select array(1, 2) as a, map('k', 1) as m, struct(1 as x) as s, array(map(1, 2)) as am")
    found = by_column(profile(df))
    assert set(found) == {"a", "m", "s", "am"} and found["a"]["distinct_count"] == 1
    assert found["m"]["distinct_count"] is None and found["am"]["null_count"] == 0


def test_approximate_profile_is_close_and_has_no_value_shuffle(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir)
    exact = {r["column"]: r["distinct_count"] for r in distinct_counts(orders).collect()}
    approx = profile(orders, top_k=0, approx_distinct=True)
    for row in approx.collect():
        assert abs(row["distinct_count"] - exact[row["column"]]) <= 0.1 * exact[row["column"]]
    plan = approx._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == plan.count("Exchange SinglePartition")


def test_statistics_and_top_values_share_one_value_shuffle(spark, sf_dir):
    df = profile(dirty_orders(spark, sf_dir).select("order_id", "payment_method"))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_suggested_rules_hold_on_their_data_and_find_faults_elsewhere(spark, sf_dir):
    columns = [c for c in clean_orders(spark, sf_dir).columns if c not in ("src_key", "batch_id")]
    clean, dirty = (f(spark, sf_dir).select(*columns) for f in (clean_orders, dirty_orders))
    own = run_suite(clean, rules_from_frame(suggest_rules(clean)))
    assert own.filter(~F.col("success")).count() == 0
    failed = check_suggested_rules(clean, dirty, dataset_name="orders").filter(~F.col("success"))
    assert {(r["column"], r["rule_type"]) for r in failed.collect()} == {
        ("order_id", "unique"),
        ("order_amount", "value_range"),
        ("product_category", "accepted_values"),
        ("payment_method", "not_null"),
    }
    dirty_rules = suggest_rules(dirty)
    assert dirty_rules.filter("rule_type = 'null_rate'").collect()[0]["max_null_rate"] == 0.15
    assert run_suite(dirty, rules_from_frame(dirty_rules)).filter(~F.col("success")).count() == 0


@pytest.mark.parametrize("table", ["nation", "events", "documents", "embeddings", "conversations"])
def test_suggested_rules_hold_on_any_table(spark, sf_dir, table):
    df = read_table(spark, sf_dir, table)
    rules = rules_from_frame(suggest_rules(df))
    assert len(rules) >= len(df.columns)
    assert run_suite(df, rules).filter(~F.col("success")).count() == 0


@pytest.mark.parametrize("k", [1, 3, 8, 40])
def test_top_values_of_long_texts(spark, k):
    """Long and short texts, equal fronts, ties at the last place, NULL, empty: as counting whole texts gives."""
    front = "the same front of many texts, longer than sixty-four bytes in all of them "
    values = [front + str(i % 9) for i in range(60)] + [front] * 7 + [None] * 7 + [""] * 7 + ["é" * 40] * 7
    values += ["short"] * 7 + [f"u{i}" for i in range(30)] + [front + "x" * 2000] * 25 + ["v" * 64] * 7 + ["d" * 65] * 7
    df = spark.createDataFrame([(v,) for v in values], "t string")
    counted = collections.Counter(values)
    best = sorted(counted.items(), key=lambda x: (-x[1], x[0] is None, (x[0] or "").encode()))[:k]
    found = top_values(df, k).orderBy("rank").collect()
    assert [(r["value"], r["rows"]) for r in found] == best
    whole = profile(df, top_k=k).collect()[0]
    assert list(whole["top_values"]) == [v for v, _ in best] and whole["distinct_count"] == len(counted)


def test_whole_texts_are_no_shuffle_key(spark, sf_dir):
    df = top_values(read_table(spark, sf_dir, "documents").select("text"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\((text|value)#", plan) and "hashpartitioning(key#" in plan


def test_a_list_is_a_share_of_the_rows(spark):
    """21 values in 21,000 rows are a list, 25 in 25 are none; a rule's own limit is a parameter."""
    df = spark.range(21_000).selectExpr("concat('v', id % 21) AS t", "concat('u', id) AS u")
    rules = {(r["column"], r["rule_type"]): r for r in suggest_rules(df).collect()}
    assert len(rules["t", "accepted_values"]["accepted"]) == 21 and ("u", "accepted_values") not in rules
    assert suggest_rules(df, max_listed=20).filter("rule_type = 'accepted_values'").count() == 0
    assert suggest_rules(df.limit(25)).filter("rule_type = 'accepted_values'").count() == 0


def test_columns_that_cannot_be_compared_have_rows_and_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (map(1, 2), 1, parse_json('1')), (NULL, 2, NULL), (map(3, 4), NULL, NULL) AS t(m, k, v)")
    for options in ({}, {"approx_distinct": True}, {"top_k": 0}):
        found = {r["column"]: r for r in profile(df, **options).collect()}
        assert [(found[c]["total_rows"], found[c]["null_count"]) for c in "mkv"] == [(3, 1), (3, 1), (3, 2)]
        assert [found[c]["distinct_count"] for c in "mkv"] == [None, 3, None]
    only = profile(df.select("m")).collect()
    assert [(r["column"], r["null_count"], r["distinct_count"]) for r in only] == [("m", 1, None)]
    assert {(r["column"], r["rule_type"]) for r in suggest_rules(df).collect()} >= {("m", "null_rate"), ("v", "null_rate")}


def test_quarantined_rows_are_no_rules(spark):
    rules = suggest_rules(spark.range(3).toDF("n")).withColumn("problem", F.lit("not JSON"))
    with pytest.raises(ValueError):
        rules_from_frame(rules)
    assert rules_from_frame(rules.withColumn("problem", F.lit(None).cast("string")))


def test_no_rules_for_no_rows(spark):
    assert suggest_rules(spark.createDataFrame([], "x double, t string")).count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "t string")
    assert [(r["rule_type"], r["max_null_rate"]) for r in suggest_rules(nulls).collect()] == [("null_rate", 1.0)]


def test_rules_survive_their_json_file(spark, sf_dir):
    rules = suggest_rules(dirty_orders(spark, sf_dir))
    path = work_path(spark, "rules")
    write_rules(rules, "orders", path)
    back = read_rules(spark, path)
    assert back.filter(F.col("problem").isNotNull()).count() == 0
    assert set(rules_from_frame(back)) == set(rules_from_frame(rules))
    write_rules(good_rules(back), "orders", f"{path}-again")
    assert spark.read.text(f"{path}-again").collect() == spark.read.text(path).collect()
