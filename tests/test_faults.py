from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import fault_rates, inject_faults, seeded_sample
from plumbline.functions.buckets import Bucket
from plumbline.operators.faults import move_to_future, negate, null_out, replace_with
from plumbline.schemas import INVALID_CATEGORIES
from plumbline.sources.bridge import AS_OF, clean_orders, dirty_orders


def test_injected_rates_are_the_stated_ones(spark, sf_dir):
    rates = {r["fault"]: r["rate"] for r in fault_rates(dirty_orders(spark, sf_dir), AS_OF).collect()}
    assert rates == {
        "null_payment": 0.15,
        "negative_amount": 0.05,
        "future_date": 0.03,
        "invalid_category": 0.07,
        "repeated_id": 0.02,
    }
    clean = fault_rates(clean_orders(spark, sf_dir), AS_OF).collect()
    assert {r["faulty_rows"] for r in clean} == {0}


def test_faults_change_only_their_rows_and_keep_types(spark, sf_dir):
    clean = clean_orders(spark, sf_dir)
    everything = Bucket(1, 1, start=0, width=1)
    faults = [
        null_out("payment_method", Bucket(3, 10, start=0, width=2)),
        negate("order_amount", everything),
        move_to_future("order_date", everything, AS_OF),
        replace_with("product_category", everything, INVALID_CATEGORIES),
        replace_with("product_category", Bucket(1, 2, start=0, width=1), ["Again"]),
    ]
    bad = inject_faults(clean, "src_key", faults)
    assert bad.dtypes == clean.dtypes
    row = bad.agg(
        F.count_if(F.col("payment_method").isNull()).alias("nulls"),
        F.max("order_amount").alias("amount"),
        F.min(F.date_diff("order_date", F.lit(AS_OF))).alias("first"),
        F.max(F.date_diff("order_date", F.lit(AS_OF))).alias("last"),
        F.count_if(F.col("product_category") == "Again").alias("again"),
    ).collect()[0]
    assert row["nulls"] == 300 and row["amount"] < 0 and row["again"] == 750
    assert (row["first"], row["last"]) == (1, 59)
    assert bad.filter("src_key % 2 = 1").select("product_category").distinct().count() == 2


def test_empty_input_has_no_rates(spark, sf_dir):
    rows = fault_rates(clean_orders(spark, sf_dir).limit(0), AS_OF).collect()
    assert {(r["total_rows"], r["rate"]) for r in rows} == {(0, None)}


def test_sample_depends_on_seed_and_not_on_layout(spark):
    df = spark.range(0, 10000, 1, 5)
    one = {r["id"] for r in seeded_sample(df, "id", 15, seed=1).collect()}
    assert 1350 < len(one) < 1650
    assert one == {r["id"] for r in seeded_sample(df.repartition(3), "id", 15, seed=1).collect()}
    assert one != {r["id"] for r in seeded_sample(df, "id", 15, seed=2).collect()}
    for seed in range(12):
        assert 850 < seeded_sample(df, "id", 10, seed=seed).count() < 1150
    text = df.selectExpr("cast(id as string) as id")
    assert 1200 < seeded_sample(text, "id", 15, seed=1).count() < 1800
    sparse = df.withColumn("id", df.id * 1000)
    assert 1200 < seeded_sample(sparse, "id", 15, seed=1).count() < 1800
