"""Samples of an exact size against sorting everything."""

from __future__ import annotations

import hashlib

import pytest

from plumbline.operators.sampling import exact_sample


@pytest.fixture
def rows():
    """Distinct keys, NULL keys, a key that holds a third of the rows, rows equal in all columns."""
    out = [(f"k{i}", i) for i in range(400)] + [(None, i) for i in range(60)]
    out += [("hot", i) for i in range(200)] + [("hot", 7)] * 50 + [("same", None)] * 120
    return out


def expected(rows, count, seed):
    def order(row):
        key, value = row
        shown = f'{{"key":{"null" if key is None else chr(34) + key + chr(34)},"value":{"null" if value is None else value}}}'
        return hashlib.md5(f"{key or ''}:{seed}".encode()).hexdigest(), hashlib.md5(shown.encode()).hexdigest()

    return sorted(sorted(rows, key=order)[:count], key=repr)


@pytest.mark.parametrize("percent,seed", [(10, 1), (33.3, 2), (50, 3), (50, 4), (87.65, 5), (0.05, 6), (99.99, 7)])
def test_equals_sorting_by_digest(spark, rows, percent, seed):
    df = spark.createDataFrame(rows, "key string, value long")
    found = sorted((tuple(r) for r in exact_sample(df, "key", percent, seed).collect()), key=repr)
    assert found == expected(rows, int(len(rows) * percent / 100 + 0.5), seed)


def test_any_layout_gives_the_same_rows(spark, rows):
    df = spark.createDataFrame(rows, "key string, value long")
    one, many = (sorted(map(tuple, exact_sample(d, "key", 40, 1).collect()), key=repr) for d in (df.coalesce(1), df.repartition(7, "value")))
    assert one == many


def test_ends(spark, rows):
    df = spark.createDataFrame(rows, "key string, value long")
    assert exact_sample(df, "key", 0, 1).count() == 0 and exact_sample(df, "key", 100, 1).count() == len(rows)
    assert exact_sample(df.limit(0), "key", 50, 1).count() == 0
    with pytest.raises(ValueError):
        exact_sample(df, "key", 101, 1)


def test_nothing_is_sorted(spark):
    plan = exact_sample(spark.range(1000), "id", 10, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
