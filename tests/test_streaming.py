from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline import not_null, order_suite, run_suite, unique
from plumbline.session import work_path
from plumbline.schemas import TRACKED_ORDERS
from plumbline.sources.bridge import AS_OF, BATCHES, FIRST_BATCH_DAY, dirty_orders, drifting_orders
from plumbline.streaming import micro_batches as mb


def arrivals(spark, root, **options):
    return mb.read_arrivals(spark, f"{root}/landing", TRACKED_ORDERS, **options)


def rows(df, *without):
    return sorted((tuple(r) for r in df.drop(*without).collect()), key=repr)


@pytest.fixture
def orders(spark, sf_dir):
    return dirty_orders(spark, sf_dir)


def test_checks_of_arriving_files_equal_the_batch_suite(spark, orders):
    root = work_path(spark, "t")
    for batch in range(BATCHES):
        mb.land(orders.filter(F.col("batch_id") == batch), f"{root}/landing", fmt="csv")
        mb.stream_checks(arrivals(spark, root, fmt="csv"), order_suite(), root, by=["batch_id"])
    stored = mb.read_epochs(spark, root, "results")
    assert rows(stored, "checked_at", "epoch") == rows(
        run_suite(orders, order_suite(), dataset_name="orders", by=["batch_id"]), "checked_at"
    )
    assert stored.filter(F.col("epoch") != F.col("batch_id")).count() == 0


def test_one_run_takes_files_in_turn(spark, orders):
    root = work_path(spark, "t")
    for batch in range(3):
        mb.land(orders.filter(F.col("batch_id") == batch).coalesce(1), f"{root}/landing")
    mb.stream_checks(arrivals(spark, root, files_per_batch=1), [not_null("order_id")], root)
    found = mb.read_epochs(spark, root, "results").orderBy("epoch").collect()
    assert [(r["epoch"], r["total_rows"]) for r in found] == [(0, 300), (1, 300), (2, 300)]


def test_a_restart_reads_only_new_files(spark, orders):
    root = work_path(spark, "t")
    for batch in (0, 1):
        mb.land(orders.filter(F.col("batch_id") == batch), f"{root}/landing")
        for _ in range(2):
            mb.stream_checks(arrivals(spark, root), [not_null("order_id")], root)
    bronze = mb.read_epochs(spark, root, "bronze")
    assert rows(bronze.groupBy("epoch").count()) == [(0, 300), (1, 300)]
    assert bronze.filter(F.col("ingested_at").isNull()).count() == 0


def test_a_repeated_epoch_replaces_its_rows(spark):
    root = work_path(spark, "t")
    for n in (5, 3):
        mb.store_epoch(spark.range(n), root, "numbers", 0)
    mb.store_epoch(spark.range(2), root, "numbers", 1)
    assert rows(mb.read_epochs(spark, root, "numbers").groupBy("epoch").count()) == [(0, 3), (1, 2)]


def test_bounded_memory_of_ids(spark, orders):
    root = work_path(spark, "t")
    timed = orders.withColumn("seen_at", F.to_timestamp("order_date"))
    for batch in (0, 1):
        mb.land(timed.filter(F.col("batch_id") == batch), f"{root}/landing")
    stream = spark.readStream.schema(timed.schema).parquet(f"{root}/landing")
    mb.stream_silver_bounded(stream, root, event_time="seen_at", delay="100000 days", as_of=AS_OF)
    silver = mb.read_epochs(spark, root, "silver")
    assert silver.count() == silver.select("order_id").distinct().count() > 0


def test_alert_on_the_batch_that_went_bad(spark, sf_dir):
    orders, root = drifting_orders(spark, sf_dir), work_path(spark, "t")
    rules = [not_null("payment_method"), unique("order_id")]
    for batch in range(4):
        mb.land(orders.filter(F.col("batch_id") == batch), f"{root}/landing")
        mb.stream_checks(arrivals(spark, root), rules, root, by=["batch_id"])
    newest = mb.drift_alerts(spark, root, first_day=FIRST_BATCH_DAY, newest_only=True)
    assert {r["batch_id"] for r in newest.collect()} == {3}
    high = mb.drift_alerts(spark, root, first_day=FIRST_BATCH_DAY, severities=["HIGH"])
    assert {r["severity"] for r in high.collect()} == {"HIGH"}
    alerts = mb.drift_alerts(spark, root, first_day=FIRST_BATCH_DAY).filter("batch_id = 3 and severity = 'HIGH'")
    assert [(r["column"], r["previous_level"], r["level"]) for r in alerts.collect()] == [("payment_method", 0.01, 0.34)]
