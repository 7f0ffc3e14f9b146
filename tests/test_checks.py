from __future__ import annotations

import datetime as dt
import decimal

import pytest

from plumbline import (
    Expectations,
    Rule,
    accepted_values,
    check_schema,
    describe,
    failing_segments,
    not_null,
    null_rate_below,
    order_suite,
    run_suite,
    summarise,
    unique,
    value_range,
)
from plumbline.operators import checks
from plumbline.schemas import ORDERS, struct_of, DOUBLE, LONG, TEXT
from plumbline.sources.bridge import dirty_orders, drifting_orders


def outcome(df, rule, **options):
    row = run_suite(df, [rule], **options).collect()[0]
    return row["success"], row["metric_value"], row["threshold"]


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1.005,), (-2.0,), (float("nan"),), (None,)], "x double")


@pytest.fixture
def letters(spark):
    return spark.createDataFrame([("A",), (None,), ("Z",), ("B",)], "c string")


def test_null_checks_count_nulls_but_not_nan(numbers):
    assert outcome(numbers, not_null("x")) == (False, 0.25, 0.0)
    assert outcome(numbers, null_rate_below("x", 0.25)) == (True, 0.25, 0.25)
    assert outcome(numbers, null_rate_below("x", 0.24)) == (False, 0.25, 0.24)


def test_null_rate_compares_the_rounded_rate(spark):
    df = spark.range(100000).selectExpr("if(id < 2, null, id) as x")
    assert outcome(df, null_rate_below("x", 0.0)) == (True, 0.0, 0.0)
    assert outcome(df, not_null("x")) == (False, 0.0, 0.0)


def test_range_ignores_null_and_treats_nan_as_largest(numbers):
    assert outcome(numbers, value_range("x", 0, 100)) == (False, 0.5, 0.0)
    assert outcome(numbers, value_range("x", min_value=0)) == (False, 0.25, 0.0)
    assert outcome(numbers, value_range("x", max_value=0)) == (False, 0.5, 0.0)
    assert outcome(numbers, value_range("x")) == (True, 0.0, 0.0)


def test_range_on_text_lets_unreadable_numbers_pass(spark):
    df = spark.createDataFrame([("5",), ("x",), ("50",)], "t string")
    assert outcome(df, value_range("t", 0, 10)) == (False, 0.3333, 0.0)


def test_accepted_values_ignore_null_unless_the_list_is_empty(letters):
    assert outcome(letters, accepted_values("c", ["A", "B"])) == (False, 0.25, 0.0)
    assert outcome(letters, accepted_values("c", [])) == (False, 1.0, 0.0)
    with pytest.raises(ValueError):
        accepted_values("c", ["A", None])


def test_accepted_text_on_a_number_column(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert outcome(df, accepted_values("n", ["1", "two"])) == (False, 0.5, 0.0)


def test_numbers_accepted_in_a_text_column(spark):
    df = spark.createDataFrame([("1",), ("x",)], "t string")
    assert outcome(df, accepted_values("t", [1, 2])) == (False, 0.5, 0.0)


@pytest.mark.parametrize(
    "kind,held,listed,failing,noted",
    [
        ("int", "1", ["1.0", "2"], 0, None),
        ("int", "1", ["1e0"], 0, None),
        ("int", "100", [1.0, 2.0, 1e2], 0, None),
        ("int", "1", [1.5, "1_0", "x", True, "nan"], 1, "1.5"),
        ("tinyint", "44", [300, 44], 0, "300"),
        ("tinyint", "44", [300], 1, "300"),
        ("bigint", "9223372036854775807", ["9223372036854775807"], 0, None),
        ("bigint", "9223372036854775807", [2**63], 1, str(2**63)),
        ("double", "15", ["1_5", "1e400", "15"], 0, "'1_5'"),
        ("double", "0.1", [decimal.Decimal("0.1")], 0, None),
        ("double", "'NaN'", ["nan"], 0, None),
        ("decimal(10,2)", "1.50", [1.504, 2.5], 1, "1.504"),
        ("decimal(10,2)", "1.50", ["1.500", 2], 0, None),
        ("decimal(3,2)", "1.50", [10**8, "1e-999999"], 1, "100000000"),
        ("decimal(38,0)", "10000000000000000000000000000000000001", ["10000000000000000000000000000000000001"], 0, None),
        ("date", "'2024-01-01'", ["20240101"], 0, None),
        ("date", "'2024-01-01'", ["2024-1-1"], 0, None),
        ("date", "'2024-01-01'", ["2024-13-01", "soon", 5, dt.datetime(2024, 1, 1, 5)], 1, "'2024-13-01'"),
        ("timestamp", "'2024-01-01 10:00:00'", ["2024-01-01T12:00:00+02:00"], 0, None),
        ("timestamp_ntz", "'2024-01-01 10:00:00'", [dt.datetime(2024, 1, 1, 10)], 0, None),
        ("timestamp_ntz", "'2024-01-01 10:00:00'", ["2024-01-01T12:00:00+02:00"], 1, "'2024-01-01T12:00:00+02:00'"),
        ("boolean", "true", ["TRUE", "maybe"], 0, "'maybe'"),
    ],
)
def test_listed_values_never_break_a_suite_nor_pass_by_rounding(spark, kind, held, listed, failing, noted):
    df = spark.sql(f"SELECT CAST({held} AS {kind}) AS v")
    rows = run_suite(df, [accepted_values("v", listed), not_null("v")]).orderBy("rule_no").collect()
    assert [r["metric_value"] for r in rows] == [float(failing), 0.0] and rows[1]["success"]
    assert rows[0]["message"] == (noted and f"accepted value {noted} does not fit type {df.schema['v'].dataType.simpleString()}")


def test_types_without_lists_are_reported(spark):
    df = spark.sql("SELECT interval 1 day AS i, X'00' AS x, 1 AS n")
    rows = run_suite(df, [accepted_values("i", ["1"]), accepted_values("x", ["a"]), not_null("n")]).orderBy("rule_no").collect()
    assert [r["success"] for r in rows] == [False, False, True] and all(r["message"] for r in rows[:2])


def test_rules_that_do_not_fit_a_type_are_reported(spark):
    df = spark.sql("select date'2024-01-01' as d, map(1, 2) as m, 5 as n, 'a' as t, true as b")
    unfit = [value_range("d", 0), value_range("n", "a"), unique("m"), accepted_values("m", ["x"]), value_range("b", 0, 1)]
    fit = [
        value_range("d", dt.date(2024, 1, 1), dt.datetime(2024, 2, 1)),
        value_range("t", "a", "b"),
        accepted_values("d", ["2024-01-01"]),
        not_null("m"),
        accepted_values("b", [True]),
    ]
    rows = run_suite(df, unfit + fit).orderBy("rule_no").collect()
    assert [r["message"] is None for r in rows] == [False] * 5 + [True] * 5
    assert [r["success"] for r in rows] == [False] * 5 + [True] * 5


def test_unique_tolerates_one_null(spark):
    one = spark.createDataFrame([(1,), (None,), (3,)], "id int")
    two = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    assert outcome(one, unique("id")) == (True, 3.0, 3.0)
    assert outcome(two, unique("id")) == (False, 2.0, 4.0)


def test_empty_frame_holds_every_rule(spark):
    empty = spark.createDataFrame([], "x double, c string")
    rules = [not_null("x"), unique("x"), value_range("x", 0), accepted_values("c", []), null_rate_below("x", 0)]
    rows = run_suite(empty, rules).collect()
    assert [r["success"] for r in rows if r["rule_type"] != "unique"] == [True] * 4
    assert [(r["success"], r["metric_value"]) for r in rows if r["rule_type"] == "unique"] == [(True, 0.0)]
    assert all(r["metric_value"] is None for r in rows if r["rule_type"] != "unique")


def test_rules_that_cannot_run_are_reported_and_the_rest_runs(letters):
    rules = [Rule("regex", "c"), not_null("gone"), Rule("null_rate", "c"), Rule("accepted_values", "c"), not_null("c")]
    rows = {r["rule_no"]: r for r in run_suite(letters, rules).collect()}
    assert rows[1]["message"] == "unknown rule type regex"
    assert rows[2]["message"] == "unknown column gone"
    assert rows[3]["message"] and rows[4]["message"]
    assert not any(rows[n]["success"] for n in (1, 2, 3, 4))
    assert rows[5]["message"] is None and rows[5]["metric_value"] == 0.25


def result_set(df):
    return {tuple(r) for r in df.drop("checked_at").collect()}


def test_one_suite_equals_one_run_per_rule(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir)
    together = result_set(run_suite(orders, order_suite()).drop("rule_no"))
    alone = set()
    for rule in order_suite():
        alone |= result_set(run_suite(orders, [rule]).drop("rule_no"))
    assert together == alone
    assert together == result_set(run_suite(orders, order_suite(), single_scan=True).drop("rule_no"))


def test_known_results_of_the_order_suite(spark, sf_dir):
    rows = run_suite(dirty_orders(spark, sf_dir), order_suite()).orderBy("rule_no").collect()
    assert [(r["success"], r["metric_value"]) for r in rows] == [
        (True, 0.0), (False, 1470.0), (True, 0.0), (False, 0.05), (True, 0.0),
        (False, 0.07), (True, 0.0), (True, 0.0), (False, 0.15),
    ]


def test_a_hot_value_is_merged_before_the_shuffle(spark):
    hot = spark.range(0, 90000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id % 2 as half")
    assert outcome(hot, unique("k")) == (False, 60001.0, 90000.0)
    results = run_suite(hot, [unique("k"), not_null("k")], by=["half"])
    found = {(r["half"], r["rule_no"]): r["metric_value"] for r in results.collect()}
    assert found == {(0, 1): 30001.0, (1, 1): 30001.0, (0, 2): 0.0, (1, 2): 0.0}
    plan = run_suite(hot, [unique("k")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan[plan.index("Exchange hashpartitioning") :]


def test_grouped_suite_equals_a_suite_per_group(spark, sf_dir):
    orders = drifting_orders(spark, sf_dir)
    grouped = run_suite(orders, order_suite(), by=["batch_id"])
    single = run_suite(orders, order_suite(), by="batch_id", single_scan=True)
    assert result_set(grouped) == result_set(single)
    for batch in range(5):
        part = run_suite(orders.filter(f"batch_id = {batch}"), order_suite())
        assert result_set(part) == result_set(grouped.filter(f"batch_id = {batch}").drop("batch_id"))


def test_summary_and_lines(letters):
    expectations = Expectations(letters, "letters").expect_not_null("c").expect_unique("c")
    expectations.expect_value_range("c").expect_accepted_values("c", ["A", "B", "Z"]).expect_null_rate_below("c", 0.5)
    assert tuple(expectations.summary().collect()[0]) == (5, 4, 1)
    lines = [r["line"] for r in describe(expectations.results()).collect()]
    assert lines[0] == "FAIL | c | not_null | metric=0.25"
    assert lines[1] == "PASS | c | unique | metric=4.0"
    assert {r["dataset_name"] for r in expectations.results().collect()} == {"letters"}


def test_groups_with_odd_names(spark):
    df = spark.createDataFrame([("x", 1), ("y", None)], "`a.b` string, n int")
    results = run_suite(df, [not_null("n"), unique("n")], by="a.b")
    assert {(r["a.b"], r["rule_no"], r["success"]) for r in results.collect()} == {
        ("x", 1, True), ("x", 2, True), ("y", 1, False), ("y", 2, True),
    }
    assert summarise(results, "a.b").count() == 2
    segments = failing_segments(df, [not_null("n")], ["a.b"], by="a.b").collect()
    assert [(r["a.b"], r["value"], r["lift"]) for r in segments] == [("y", "y", 1.0)]


def test_summary_per_group(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "batch int, c string")
    results = run_suite(df, [not_null("c"), unique("c")], by=["batch"])
    assert {tuple(r) for r in summarise(results, ["batch"]).collect()} == {(1, 2, 1, 1), (2, 2, 2, 0)}


def test_schema_contract(spark):
    df = spark.createDataFrame(
        [("1", 5, "30.5", 1), ("2", 6, "n/a", 2), (None, 7, None, 3)],
        "a string, b bigint, c string, extra int",
    )
    rows = check_schema(df, struct_of(a=TEXT, b=DOUBLE, c=DOUBLE, d=LONG)).collect()
    found = {r["column"]: (r["problem"], r["unreadable_cells"]) for r in rows}
    assert found == {
        "a": (None, 0),
        "b": ("wrong_type", 0),
        "c": ("wrong_type", 1),
        "d": ("missing", 0),
        "extra": ("extra", 0),
    }
    fine = check_schema(spark.createDataFrame([], ORDERS), ORDERS).collect()
    assert all(r["problem"] is None for r in fine) and len(fine) == 8


def test_listed_texts_are_compared_as_the_column_type(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (None, None)], "d double, i int")
    rules = [
        checks.accepted_values("d", ["1", "2.0"]),
        checks.accepted_values("i", ["1"]),
        checks.accepted_values("d", ["many"]),
        checks.accepted_values("i", ["1.5"]),
    ]
    found = checks.run_suite(df, rules).orderBy("rule_no").collect()
    assert [r.success for r in found] == [True, False, False, False]
    assert [r.metric_value for r in found] == [0.0, 0.3333, 0.6667, 0.6667]
    assert [r.message for r in found[:2]] == [None, None]
    assert "many" in found[2].message and "1.5" in found[3].message
