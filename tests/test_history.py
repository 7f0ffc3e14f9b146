from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline import (
    attribute_failures,
    batch_drift,
    failing_segments,
    failure_severity,
    not_null,
    read_history,
    order_suite,
    root_cause_report,
    root_cause_prompt,
    run_suite,
    unique,
    write_history,
)
from plumbline.operators import checks, monitor
from plumbline.operators.dedup import upsert_by_key
from plumbline.operators.profile import profile
from plumbline.operators.suggest import rules_from_frame, suggest_from_profile
from plumbline.schemas import HISTORY
from plumbline.session import work_path
from plumbline.sources.bridge import FIRST_BATCH_DAY, drifting_orders

DIMENSIONS = ["product_category", "delivery_status", "batch_id"]


@pytest.fixture
def history(spark):
    def row(check, column, status, metric, hour, batch):
        return ("orders", check, column, status, metric, dt.datetime(2026, 3, 17, hour), f"batch_{batch}")

    rows = [
        row("expect_not_null", "payment_method", "FAIL", 0.34, 10, 3),
        row("expect_unique", "order_id", "PASS", 0.0, 10, 3),
        row("expect_value_range", "order_amount", "PASS", 0.0, 10, 3),
        row("expect_accepted_values", "product_category", "PASS", 0.0, 10, 3),
        row("expect_not_null", "order_id", "PASS", 0.0, 9, 2),
        row("expect_not_null", "payment_method", "PASS", 0.01, 9, 2),
        row("expect_value_range", "customer_age", "PASS", 0.0, 8, 1),
        row("expect_accepted_values", "delivery_status", "FAIL", 0.07, 8, 1),
    ]
    return spark.createDataFrame(rows, HISTORY)


@pytest.fixture
def drifting(spark, sf_dir):
    return drifting_orders(spark, sf_dir)


def test_key_figures(history):
    assert tuple(monitor.kpis(history).collect()[0]) == (8, 6, 2, 75.0)
    assert tuple(monitor.kpis(history.limit(0)).collect()[0]) == (0, 0, 0, None)


def test_listing_and_failures(history):
    listed = monitor.listing(history).collect()
    assert len(listed) == 8 and listed[0]["batch"] == "batch_3" and listed[-1]["batch"] == "batch_1"
    assert {r["column"] for r in monitor.failed(history).collect()} == {"payment_method", "delivery_status"}
    top = monitor.top_failing_columns(history).collect()
    assert [tuple(r) for r in top] == [("delivery_status", 1), ("payment_method", 1)]


def test_trend_has_every_day(history):
    rows = monitor.pass_rate_trend(history, dt.date(2026, 3, 18)).orderBy("day").collect()
    assert len(rows) == 14 and rows[0]["day"] == dt.date(2026, 3, 5)
    assert tuple(rows[12]) == (dt.date(2026, 3, 17), 8, 0.75)
    assert (rows[13]["checks"], rows[13]["pass_rate"]) == (0, None)


def test_labels_come_apart_again(history):
    rows = {tuple(r) for r in monitor.failure_labels(history).collect()}
    assert rows == {
        ("batch_3 | payment_method | expect_not_null", "batch_3", "payment_method", "expect_not_null"),
        ("batch_1 | delivery_status | expect_accepted_values", "batch_1", "delivery_status", "expect_accepted_values"),
    }


def test_stored_history_keeps_datasets_and_times_apart(spark):
    path = work_path(spark, "history")
    df = spark.createDataFrame([("a", 1), ("b", None)], "day string, v int")
    for name in ("orders", "customers", "orders"):
        results = checks.run_suite(df, [checks.not_null("v")], dataset_name=name, by=["day"])
        write_history(monitor.to_history(results, batch="day"), path)
    found = read_history(spark, path).collect()
    assert sorted((r.dataset_name, r.batch, r.status) for r in found) == [
        ("customers", "batch_a", "PASS"), ("customers", "batch_b", "FAIL"), ("orders", "batch_a", "PASS"), ("orders", "batch_b", "FAIL"),
    ]
    assert all(r.timestamp is not None for r in found)


def test_stored_history_replaces_a_batch_checked_again(spark, history):
    path = work_path(spark, "history")
    write_history(history, path)
    again = history.filter("batch = 'batch_1'").withColumn("status", F.lit("PASS"))
    write_history(again, path)
    stored = read_history(spark, path)
    assert stored.columns == history.columns
    assert tuple(monitor.kpis(stored).collect()[0]) == (8, 7, 1, 87.5)
    one = stored.filter("batch = 'batch_3'")
    assert one.count() == 4 and len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(batch" in one._jdf.queryExecution().executedPlan().toString()


def test_drift_of_the_missing_payment_methods(drifting):
    rules = [not_null("payment_method"), unique("order_id")]
    drift = batch_drift(run_suite(drifting, rules, by=["batch_id"]), first_day=FIRST_BATCH_DAY)
    rows = drift.filter("rule_no = 1").orderBy("batch_id").collect()
    assert [r["level"] for r in rows] == [0.01, 0.01, 0.01, 0.34, 0.01]
    assert [r["change"] for r in rows] == [None, 0.0, 0.0, 0.33, -0.33]
    assert rows[3]["batch_date"] == dt.date(2001, 12, 30) and rows[3]["previous_rows"] == 300
    distinct = drift.filter("rule_no = 2").collect()
    assert {r["level"] for r in distinct} == {0.98} and {r["change"] for r in distinct} == {None, 0.0}
    grades = {r["batch_id"]: r["severity"] for r in failure_severity(drift).filter("rule_no = 1").collect()}
    assert grades == {0: "MEDIUM", 1: "LOW", 2: "LOW", 3: "HIGH", 4: "LOW"}


def test_a_lower_distinct_share_is_worse(spark):
    rows = [(b, i // 2 if b else i) for b in (0, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "batch_id long, id int")
    drift = batch_drift(run_suite(df, [unique("id")], by=["batch_id"]), first_day=FIRST_BATCH_DAY)
    failures = failure_severity(drift).collect()
    assert [(r["batch_id"], r["change"], r["severity"]) for r in failures] == [(1, -0.5, "HIGH")]


def test_attribution_names_the_bad_batch_first(drifting):
    rows = attribute_failures(drifting, not_null("payment_method"), DIMENSIONS, k=3).orderBy("rank").collect()
    assert (rows[0]["dimension"], rows[0]["value"], rows[0]["failing_rows"], rows[0]["lift"]) == ("batch_id", "3", 102, 4.4737)
    assert (rows[1]["dimension"], rows[1]["value"], rows[1]["failing_rows"], rows[1]["lift"]) == ("product_category", "Unknown", 21, 2.6316)
    assert len(rows) == 3


def test_segments_add_up(drifting):
    segments = failing_segments(drifting, order_suite(), DIMENSIONS)
    totals = segments.groupBy("rule_no", "dimension").agg(F.sum("failing_rows").alias("n"))
    per_rule = totals.groupBy("rule_no").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    assert {(r["rule_no"], r["low"], r["high"]) for r in per_rule.collect()} == {
        (2, 60, 60),
        (4, 75, 75),
        (6, 105, 105),
        (9, 114, 114),
    }


def test_segments_keep_a_group_without_name_and_share_one_shuffle(spark):
    rows = [(None, "a", None), (None, "a", 1), (1, "b", None), (1, None, None), (1, "b", 1)]
    df = spark.createDataFrame(rows, "batch_id long, kind string, x int")
    segments = failing_segments(df, [not_null("x")], ["kind"], by=["batch_id"])
    found = {(r["batch_id"], r["value"], r["failing_rows"], r["share"]) for r in segments.collect()}
    assert found == {(None, "a", 1, 1.0), (1, "b", 1, 0.5), (1, None, 1, 0.5)}
    assert "ReusedExchange" in segments._jdf.queryExecution().executedPlan().toString()


def test_segments_leave_out_rules_without_failing_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", 1)], "kind string, x int")
    rules = [unique("x"), not_null("gone"), not_null("x")]
    assert [r["rule_no"] for r in failing_segments(df, rules, ["kind"]).collect()] == [3]
    with pytest.raises(ValueError):
        failing_segments(df, rules[1:2], ["kind"])


def test_report_and_prompt(drifting):
    rules = order_suite()
    results = run_suite(drifting, rules, by=["batch_id"])
    failures = failure_severity(batch_drift(results, first_day=FIRST_BATCH_DAY))
    segments = failing_segments(drifting, rules, DIMENSIONS[:2], by=["batch_id"])
    report = root_cause_report(failures, segments)
    row = report.filter("batch_id = 3 and column = 'payment_method'").collect()[0]
    assert row["explanation"].startswith("failing share of payment_method went from 1.00% to 34.00%; ")
    assert row["severity"] == "HIGH" and row["marker"] == "🔴" and 0 < row["confidence"] <= 1
    assert row["recommended_investigation"].startswith("check the load of 2001-12-30 for ")
    assert report.count() == failures.count()
    repeated = report.filter("column = 'order_id' and batch_id = 0").collect()[0]
    own = [r for r in segments.filter("batch_id = 0 and rule_no = 2").collect()]
    top = min(own, key=lambda r: (-r["lift"], -r["failing_rows"], r["dimension"], r["value"]))
    assert repeated["explanation"] == (
        "distinct share of order_id is 98.00% in the first batch; "
        f"{top['dimension']} {top['value']} holds {100 * top['share']:.2f}% of the failing rows"
    )
    prompt = root_cause_prompt(failures).filter("batch_id = 3 and column = 'payment_method'").collect()[0]["prompt"]
    assert '"metric":0.01' in prompt and '"metric":0.34' in prompt and "2001-12-29" in prompt


def test_tied_updates_do_not_depend_on_the_layout(spark):
    target = spark.createDataFrame([(1, 1, "t")], "k int, at int, v string")
    for order in ([(1, 2, "a"), (1, 2, "b")], [(1, 2, "b"), (1, 2, "a")]):
        updates = spark.createDataFrame(order, "k int, at int, v string").coalesce(1)
        assert upsert_by_key(target, updates, ["k"], [F.desc("at")]).first().v == "b"


@pytest.mark.parametrize("top_k", [1, 3, 5, 20])
def test_suggested_rules_hold_on_their_own_data(spark, top_k):
    df = spark.createDataFrame([(i, f"v{i % 10}", None if i % 4 else "x") for i in range(200)], "i int, t string, n string")
    rules = rules_from_frame(suggest_from_profile(profile(df, top_k=top_k)))
    assert rules and all(r.success for r in checks.run_suite(df, rules).collect())
