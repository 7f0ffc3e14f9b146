"""One streaming run that keeps all tables: same results as batch runs, whole epochs, flat cost."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from plumbline import daily_orders, not_null, order_suite, revenue_by_category, to_silver
from plumbline.schemas import TRACKED_ORDERS
from plumbline.session import work_path
from plumbline.sources.bridge import AS_OF, FIRST_BATCH_DAY, dirty_orders, drifting_orders
from plumbline.streaming import epochs as ep
from plumbline.streaming import micro_batches as mb

TABLES = ["bronze", "judged", "gold", "uniqueness", "snapshots", "results", "history", "alerts"]


def rows(df, *without):
    return sorted((tuple(r) for r in df.drop(*without).collect()), key=repr)


def landing(root, **options):
    return ep.Landing(f"{root}/landing", TRACKED_ORDERS, **options)


def keep(**options):
    return ep.Keep(order_suite(), as_of=AS_OF, batch="batch_id", first_day=FIRST_BATCH_DAY, profiled=True, **options)


@pytest.fixture
def orders(spark, sf_dir):
    return dirty_orders(spark, sf_dir)


def land(orders, root, *batches):
    for batch in batches:
        mb.land(orders.filter(F.col("batch_id") == batch).coalesce(1), f"{root}/landing")


def epochs_of(spark, root, name):
    return sorted(r[0] for r in ep.committed(spark, root, name).select("epoch").distinct().collect())


def test_layers_equal_the_batch_layers(spark, orders):
    root = work_path(spark, "t")
    for batch in range(5):
        land(orders, root, batch)
        ep.run_available(spark, landing(root), root, ep.Keep(as_of=AS_OF))
    silver = to_silver(orders, as_of=AS_OF).drop("transformed_at")
    assert rows(ep.stored_silver(spark, root), "epoch") == rows(silver)
    assert rows(ep.stored_revenue_by_category(spark, root)) == rows(revenue_by_category(silver))
    assert rows(ep.stored_daily_orders(spark, root)) == rows(daily_orders(silver))


@pytest.mark.parametrize("table", ["gold", "history", ep.MANIFEST])
def test_tables_of_an_epoch_appear_together_or_not_at_all(spark, orders, monkeypatch, table):
    """Killed before a table of epoch 1 is written, then run again."""
    root, real, calls = work_path(spark, "t"), ep.store_epoch, []

    def breaks_once(df, root, name, epoch):
        calls.append((name, epoch))
        if (name, epoch) == (table, 1) and calls.count((table, 1)) == 1:
            raise RuntimeError("lost")
        return real(df, root, name, epoch)

    monkeypatch.setattr(ep, "store_epoch", breaks_once)
    land(orders, root, 0, 1)
    with pytest.raises(Exception, match="lost"):
        ep.run_available(spark, landing(root, files_per_batch=1), root, keep())
    assert mb.read_epochs(spark, root, "bronze").select("epoch").distinct().count() == 2  # stored, not shown
    assert {name: epochs_of(spark, root, name) for name in TABLES} == dict.fromkeys(TABLES, [0])
    ep.run_available(spark, landing(root, files_per_batch=1), root, keep())
    assert calls.count(("bronze", 1)) == 2
    assert {name: epochs_of(spark, root, name) for name in TABLES} == dict.fromkeys(TABLES, [0, 1])
    silver = to_silver(orders.filter("batch_id < 2"), as_of=AS_OF).drop("transformed_at")
    assert rows(ep.stored_silver(spark, root), "epoch") == rows(silver)
    assert rows(ep.stored_revenue_by_category(spark, root)) == rows(revenue_by_category(silver))


def test_an_id_of_an_earlier_batch_is_a_duplicate_even_if_it_was_rejected(spark, order_rows):
    good, bad = order_rows({"order_id": "x"}, {"order_id": "y", "order_amount": -1.0})
    nameless = order_rows({"order_id": None})[0]
    first = [(1, *good, 0), (2, *bad, 0), (3, *nameless, 0), (8, *nameless, 0)]
    late = order_rows({"order_id": "x", "order_amount": 99.0}, {"order_id": "y", "order_amount": 99.0}, {"order_id": "z"})
    second = [(4, *late[0], 1), (5, *late[1], 1), (6, *late[2], 1), (7, *nameless, 1)]
    root = work_path(spark, "a folder 100%")
    for part in (first, second, [], first):
        mb.land(spark.createDataFrame(part, TRACKED_ORDERS), f"{root}/landing")
        ep.run_available(spark, landing(root), root)
    assert sorted(r["src_key"] for r in ep.stored_silver(spark, root).collect()) == [1, 3, 6]
    assert [(r["src_key"], r["reasons"]) for r in ep.stored_rejects(spark, root).collect()] == [(2, ["order_amount"])]
    unique = ep.committed(spark, root, "uniqueness").orderBy("epoch").collect()
    assert [(r["all_rows"], r["all_keys"], r["success"]) for r in unique][:2] == [(4, 3, False), (8, 4, False)]
    assert (unique[-1]["all_rows"], unique[-1]["all_keys"], unique[-1]["new_keys"]) == (12, 4, 0)


def test_new_rows_are_dealt_once(spark, order_rows):
    """Rows, their counts and the state are shuffled by the key, none of them again for a join."""
    some = order_rows({"order_id": "old"}, {"order_id": "new"}, {"order_id": None}, {"order_id": None})
    bronze = spark.createDataFrame([(k, *row, 0) for k, row in enumerate(some)], TRACKED_ORDERS)
    known = [(False, "old", None, 2), (False, "new", None, 1), (False, None, None, 2), (True, None, "f", 4)]
    touched = spark.createDataFrame(known, "is_file boolean, key string, file string, times long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with many keys
    try:
        new = ep._new_rows(bronze, touched, "order_id")
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3, plan
        assert [r["order_id"] for r in new.collect()] == ["new"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for times, kept in ((2, ["new", None]), (3, ["new"])):
        assert [r["order_id"] for r in ep._new_rows(bronze, touched, "order_id", times).collect()] == kept


def test_a_key_is_looked_up_once_an_epoch(spark, order_rows):
    """The state does not count its rows by a second look; the epochs count the keys."""
    root = work_path(spark, "t")
    for ids in (["a", "b", "b", None], ["b", "c"], ["a", "c", None]):
        some = order_rows(*[{"order_id": i} for i in ids])
        mb.land(spark.createDataFrame([(k, *row, 0) for k, row in enumerate(some)], TRACKED_ORDERS).coalesce(1), f"{root}/landing")
    told = ep.run_available(spark, landing(root, files_per_batch=1), root, ep.Keep(as_of=AS_OF))
    # A row per key, and one for the file.
    assert [p["state_lookups"] for p in told] == [4, 3, 4]
    assert [p["state_rows"] for p in told] == [3, 4, 4]
    assert spark.conf.get(ep._COUNTED, None) is None


def test_keys_that_came_once_are_not_compared(spark, order_rows):
    """Only keys that came more than once can be old: the others are not joined with the rows."""
    some = order_rows(*[{"order_id": i} for i in ("old", "twice", "twice", "once")])
    bronze = spark.createDataFrame([(k, *row, 0) for k, row in enumerate(some)], TRACKED_ORDERS)
    known = [(False, "old", None, 2), (False, "twice", None, 2), (False, "once", None, 1), (True, None, "f", 4)]
    touched = spark.createDataFrame(known, "is_file boolean, key string, file string, times long")
    new = ep._new_rows(bronze, touched, "order_id")
    assert sorted(r["order_id"] for r in new.collect()) == ["once", "twice"]
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "> 1" in plan, plan


def test_rows_of_keys_that_came_once_are_not_dealt(spark, order_rows):
    """Only rows of keys that came more than once, if few, are shuffled; the result is that of dealing all rows."""
    some = order_rows(*[{"order_id": i} for i in ("old", "twice", "twice", "once", "here", "here", None, None)])
    bronze = spark.createDataFrame([(k, *row, 0) for k, row in enumerate(some)], TRACKED_ORDERS)
    known = [(False, "old", None, 2), (False, "twice", None, 3), (False, "here", None, 2), (False, None, None, 2), (True, None, "f", 8)]
    touched = spark.createDataFrame(known, "is_file boolean, key string, file string, times long")
    assert ep._few(touched)
    for nameless in (2, 3, 0):
        dealt = ep._new_rows(bronze, touched, "order_id", nameless)
        some_dealt = ep._new_rows(bronze, touched, "order_id", nameless, True)
        assert sorted(some_dealt.collect(), key=str) == sorted(dealt.collect(), key=str)
        assert {r["order_id"] for r in some_dealt.collect()} == {"once", "here"} | ({None} if nameless == 2 else set())
    plan = ep._new_rows(bronze, touched, "order_id", 0, True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan, plan


def test_many_repeated_keys_are_not_sent(spark, monkeypatch):
    known = [(False, str(k), None, 2) for k in range(100)]
    touched = spark.createDataFrame(known, "is_file boolean, key string, file string, times long")
    monkeypatch.setattr(ep, "_KEYS_SENT", 100 * ep._KEY_BYTES + 190)
    assert ep._few(touched)
    monkeypatch.setattr(ep, "_KEYS_SENT", 100 * ep._KEY_BYTES + 189)
    assert not ep._few(touched)
    assert ep._few(touched.filter("times > 2"))


@pytest.mark.parametrize("sent", [ep._KEYS_SENT, -1])
def test_an_epoch_stores_repeated_keys_and_a_quarter_of_the_partitions(spark, order_rows, monkeypatch, sent):
    """Of the keys only repeated ones are stored beside the state, and the state has fewer partitions than rows have."""
    monkeypatch.setattr(ep, "_KEYS_SENT", sent)
    root, partitions = work_path(spark, "t"), spark.conf.get("spark.sql.shuffle.partitions")
    for n, ids in enumerate((["a", "b", "b", None], ["b", "c", "a", "d", "d"])):
        some = order_rows(*[{"order_id": i} for i in ids])
        mb.land(spark.createDataFrame([(10 * n + k, *row, 0) for k, row in enumerate(some)], TRACKED_ORDERS).coalesce(1), f"{root}/landing")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 8))
    try:
        ep.run_available(spark, landing(root, files_per_batch=1), root, ep.Keep(as_of=AS_OF))
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores + 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    stored = spark.read.parquet(f"{root}/touched").filter("not is_file")
    assert sorted((r["key"], r["times"]) for r in stored.collect()) == [("a", 2), ("b", 3), ("d", 2)]
    assert len([x for x in os.listdir(f"{root}/checkpoint/state/0") if x.isdigit()]) == max((cores + 8) // 4, cores)
    kept = [("a", 0), ("b", 0), (None, 0), ("c", 1), ("d", 1)]
    assert rows(ep.committed(spark, root, "judged").select("order_id", "epoch")) == sorted(kept, key=repr)


def test_twenty_batches_cost_the_same_each(spark, orders, monkeypatch):
    """An epoch looks up its own keys and reads its own tables and the results before, whatever is stored."""
    root, read, load = work_path(spark, "t"), [], DataFrameReader.load
    parquet = DataFrameReader.parquet

    def noted(method):
        def call(self, *paths, **options):
            read.extend(p for path in paths for p in (path if isinstance(path, list) else [path]))
            return method(self, *paths, **options)

        return call

    small = orders.filter("batch_id < 4").withColumn("batch_id", F.pmod("src_key", F.lit(20)))
    land(small, root, *range(20))
    files = len(small.sparkSession.read.parquet(f"{root}/landing").inputFiles())
    monkeypatch.setattr(DataFrameReader, "load", noted(load))
    monkeypatch.setattr(DataFrameReader, "parquet", noted(parquet))
    kept = ep.Keep([not_null("order_id")], as_of=AS_OF, batch="batch_id", first_day=FIRST_BATCH_DAY)
    told = ep.run_available(spark, landing(root, files_per_batch=1), root, kept)
    assert files == len(told) == 20
    assert told[-1]["state_rows"] > 10 * told[0]["state_rows"]
    lookups = [p["state_lookups"] / p["input_rows"] for p in told]
    assert max(lookups) <= 2 * min(lookups) and max(lookups) <= 2.1
    tables = [p for p in read if f"{root}/" in p and "/landing/" not in p and not p.endswith("touched")]
    of_epoch = [(p, int(p.rsplit("=", 1)[1])) for p in tables]
    assert {p.rsplit("/", 2)[1] for p, _ in of_epoch} <= {*TABLES, ep.MANIFEST}
    # Reads of epoch e follow each other: nothing older than the results and totals of e - 1 is among them.
    newest = 0
    for path, epoch in of_epoch[1:]:
        newest = max(newest, epoch)
        assert epoch >= newest - ("/results/" in path or "/uniqueness/" in path), path
    assert len([p for p in read if "/landing/" in p]) == 20


def test_a_running_trigger_stops_by_its_rule(spark, orders):
    root = work_path(spark, "t")
    land(orders, root, 0, 1, 2)
    told = ep.run_for(spark, landing(root, files_per_batch=1), root, keep(), epochs=2)
    assert [p["epoch"] for p in told][:2] == [0, 1] and told[0]["input_rows"] == 300
    rest = ep.run_for(spark, landing(root, files_per_batch=1), root, keep(), idle_seconds=1.5)
    assert sorted({p["epoch"] for p in told + rest}) == [0, 1, 2] == epochs_of(spark, root, "alerts")
    assert ep.run_for(spark, landing(root), root, keep(), seconds=0.5) == []
    with pytest.raises(ValueError):
        ep.run_for(spark, landing(root), root)


def test_a_failing_run_says_so(spark, orders, monkeypatch):
    root = work_path(spark, "t")
    land(orders, root, 0)

    def breaks(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ep, "store_epoch", breaks)
    with pytest.raises(Exception, match="lost"):
        ep.run_for(spark, landing(root), root, seconds=60)


def test_alerts_without_a_batch_column_compare_epochs(spark, sf_dir):
    orders, root = drifting_orders(spark, sf_dir), work_path(spark, "t")
    land(orders, root, 2, 3, 4)
    ep.run_available(spark, landing(root, files_per_batch=1), root, ep.Keep(order_suite(), first_day=FIRST_BATCH_DAY))
    alerts = ep.committed(spark, root, "alerts").filter("column = 'payment_method' AND severity = 'HIGH'").collect()
    assert {(r["epoch"], r["previous_level"], r["level"]) for r in alerts} == {(1, 0.01, 0.34)}
    assert rows(ep.committed(spark, root, "history").select("batch").distinct()) == [("batch_0",), ("batch_1",), ("batch_2",)]


def test_csv_files(spark, orders):
    root = work_path(spark, "t")
    mb.land(orders.filter("batch_id = 0"), f"{root}/landing", fmt="csv")
    ep.run_available(spark, landing(root, fmt="csv"), root, ep.Keep(as_of=AS_OF))
    silver = to_silver(orders.filter("batch_id = 0"), as_of=AS_OF).drop("transformed_at")
    assert rows(ep.stored_silver(spark, root), "epoch") == rows(silver)
