from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plumbline import (
    daily_orders,
    keep_any,
    keep_first,
    read_orders_csv,
    reject_rate,
    reject_reasons,
    revenue_by_category,
    run_medallion,
    to_silver,
    upsert_by_key,
    write_csv,
)
from plumbline.functions.numeric import round_to
from plumbline.operators.gold import revenue_by_category
from plumbline.schemas import ORDERS
from plumbline.session import work_path
from plumbline.sources.bridge import AS_OF, BATCHES, dirty_orders
from plumbline.sources.layers import CORRUPT

TODAY = dt.date(2024, 6, 1)


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS)


def test_csv_cells_that_do_not_fit_become_null(spark, tmp_path):
    lines = [
        "order_id,customer_id,order_amount,order_date,product_category,payment_method,delivery_status,customer_age",
        "1,c,abc,notadate,Books,UPI,Delivered,30.0",
        '2,c,1.5,2024-1-5,Books,"",Delivered,30',
        "3,c,2.5",
        "4,c,3.5,2024-01-06,Books,UPI,Delivered,31,more",
    ]
    (tmp_path / "orders.csv").write_text("\n".join(lines) + "\n")
    rows = {r["order_id"]: r for r in read_orders_csv(spark, str(tmp_path)).collect()}
    assert (rows["1"]["order_amount"], rows["1"]["order_date"], rows["1"]["customer_age"]) == (None, None, None)
    assert rows["2"]["order_date"] == dt.date(2024, 1, 5) and rows["2"]["payment_method"] is None
    assert rows["3"]["order_amount"] == 2.5 and rows["3"]["customer_age"] is None
    assert rows["4"]["customer_age"] == 31
    kept = read_orders_csv(spark, str(tmp_path), keep_corrupt=True).cache()
    assert {r["order_id"] for r in kept.filter(F.col(CORRUPT).isNotNull()).collect()} == {"1", "3", "4"}
    kept.unpersist()


def test_csv_header_names_matter_only_when_asked(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "customer_id,order_id,order_amount,order_date,product_category,payment_method,delivery_status,customer_age\n"
        "x,y,1,2024-01-01,Books,UPI,Delivered,30\n"
    )
    assert read_orders_csv(spark, str(tmp_path)).collect()[0]["order_id"] == "x"
    with pytest.raises(Exception):
        read_orders_csv(spark, str(tmp_path), enforce_header=True).collect()


def test_csv_round_trip(spark, order_rows):
    df = orders(spark, order_rows({}, {"order_id": "b", "payment_method": None, "order_amount": -1.25}))
    path = work_path(spark, "csv")
    write_csv(df, path)
    assert sorted(read_orders_csv(spark, path).collect()) == sorted(df.collect())


def test_silver_rejects_each_kind_of_bad_row(spark, order_rows):
    bad = [
        {"order_amount": 0.0}, {"order_amount": -1.0}, {"order_amount": None},
        {"order_date": dt.date(2024, 6, 2)}, {"order_date": None},
        {"product_category": "books"}, {"product_category": None},
        {"payment_method": "Cash"}, {"payment_method": None},
        {"delivery_status": "Lost"}, {"customer_age": 17}, {"customer_age": 101}, {"customer_age": None},
    ]
    good = [{"order_date": TODAY}, {"customer_age": 18}, {"customer_age": 100}, {"order_amount": 1.005}]
    rows = order_rows(*[{"order_id": str(i), **change} for i, change in enumerate([*bad, *good])])
    silver = to_silver(orders(spark, rows), as_of=TODAY).collect()
    assert sorted(int(r["order_id"]) for r in silver) == [13, 14, 15, 16]
    assert {r["order_amount"] for r in silver} == {10.0, 1.01}
    assert all(r["transformed_at"] is not None for r in silver)


def test_today_is_the_default_limit(spark, order_rows):
    later = dt.date.today() + dt.timedelta(days=2)
    df = orders(spark, order_rows({"order_id": "old"}, {"order_id": "new", "order_date": later}))
    assert [r["order_id"] for r in to_silver(df).collect()] == ["old"]


def test_a_bad_survivor_takes_its_id_along(spark, order_rows):
    rows = order_rows({"order_amount": 5.0}, {"order_amount": 9.0, "payment_method": None})
    assert to_silver(orders(spark, rows), as_of=TODAY).count() == 0
    ids = orders(spark, order_rows({"order_id": None}, {"order_id": None, "order_amount": 20.0}, {}))
    assert sorted(r["order_amount"] for r in to_silver(ids, as_of=TODAY).collect()) == [10.0, 20.0]
    assert to_silver(ids, as_of=TODAY, any_survivor=True).count() == 2


def test_survivor_does_not_depend_on_layout(spark, sf_dir):
    raw = dirty_orders(spark, sf_dir)
    want = sorted(to_silver(raw, as_of=AS_OF).drop("transformed_at").collect())
    for layout in (raw.repartition(7), raw.orderBy(F.desc("src_key")).coalesce(1)):
        assert sorted(to_silver(layout, as_of=AS_OF).drop("transformed_at").collect()) == want
    assert keep_any(raw, ["order_id"]).count() == 1470


def test_known_totals(spark, sf_dir):
    raw = dirty_orders(spark, sf_dir)
    assert [r["count"] for r in raw.groupBy("batch_id").count().collect()] == [300] * BATCHES
    layers = run_medallion(raw, work_path(spark, "run"), as_of=AS_OF)
    assert (layers.bronze.count(), layers.silver.count()) == (1500, 1080)
    found = {r["product_category"]: (r["total_orders"], r["total_revenue"]) for r in layers.revenue_by_category.collect()}
    assert found == {
        "Books": (270, 66019495.21),
        "Clothing": (225, 55901607.52),
        "Electronics": (295, 77474117.16),
        "Food": (290, 72890899.27),
    }
    days = [r["order_date"] for r in layers.daily_orders.collect()]
    assert days == sorted(days)
    assert layers.profile.count() == 10
    assert tuple(reject_rate(layers.bronze, layers.silver).collect()[0]) == (1500, 1080, 0.28)
    reasons = {r["reason"]: r["rejected_rows"] for r in reject_reasons(raw, as_of=AS_OF).collect()}
    assert reasons == {
        "order_amount": 75, "order_date": 45, "product_category": 105, "payment_method": 210,
        "delivery_status": 0, "customer_age": 0, "any": 390,
    }


def test_reject_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], ORDERS)
    assert tuple(reject_rate(empty, empty).collect()[0]) == (0, 0, None)


def test_revenue_falls_back_to_doubles_where_decimals_do_not_reach(spark, order_rows):
    rows = order_rows(
        {"order_amount": 0.1}, {"order_amount": 0.2}, {"order_id": None, "order_amount": None},
        {"product_category": "Food", "order_amount": float("nan")}, {"product_category": "Food"},
        {"product_category": "Clothing", "order_amount": 1e30}, {"product_category": None},
    )
    found = {r["product_category"]: r for r in revenue_by_category(orders(spark, rows)).collect()}
    assert found["Books"]["total_revenue"] == 0.3 and found["Books"]["total_orders"] == 2
    assert found["Books"]["avg_order_value"] == 0.15
    assert math.isnan(found["Food"]["total_revenue"])
    assert found["Clothing"]["total_revenue"] == 1e30
    assert found[None]["total_revenue"] == 10.0
    assert daily_orders(orders(spark, rows)).count() == 1


def test_upsert_keeps_the_newest(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 5, "t"), ("c", 3, "t"), (None, 1, "t")], "k string, v int, s string")
    updates = spark.createDataFrame([("a", 2, "u"), ("b", 4, "u"), ("c", 3, "u"), ("d", 1, "u"), ("d", 2, "u"), (None, 2, "u")], "k string, v int, s string")
    rows = {tuple(r) for r in upsert_by_key(target, updates, ["k"], [F.desc("v")]).collect()}
    assert rows == {("a", 2, "u"), ("b", 5, "t"), ("c", 3, "u"), ("d", 2, "u"), (None, 2, "u")}


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as v")
    first = keep_first(hot, ["k"], [F.desc("v")])
    assert first.count() == 20001
    assert first.filter("k = 'hot'").collect()[0]["v"] == 29997
    plan = first._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_work_path_uses_the_named_folder(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_path(spark, "x") != work_path(spark, "x")


def test_totals_keep_amounts_below_a_cent_and_huge_ones(spark):
    def total(amounts):
        rows = [(str(i), a, "Books") for i, a in enumerate(amounts)]
        df = spark.createDataFrame(rows, "order_id string, order_amount double, product_category string")
        return revenue_by_category(df.repartition(3)).first().total_revenue

    assert total([0.004] * 1000) == pytest.approx(4.0, abs=1e-9)
    assert total([0.1] * 10 + [2e13]) == 20000000000001.0
    assert total([1e300, 1.5]) == 1e300
    assert total([0.1] * 30) == 3.0
    assert total([float("nan"), 1.0]) != total([float("nan"), 1.0])
    assert total([None, None]) is None


def test_rounding_has_no_upper_end(spark):
    values = [1234567890123.4567, -1234567890123.4567, 2.0**53, 1e300, 1000000000000.005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in df.select(round_to(df.v, 2)).collect()]
    assert found[:4] == [1234567890123.46, -1234567890123.46, 2.0**53, 1e300]
    assert found[4] in (1000000000000.0, 1000000000000.01)
