from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import canonical, connect
from oracles import sql
from plumbline.catalog import QUERIES

STREAMS = [n for n in QUERIES if n.startswith("stream_")]
SKETCHED = {"profile_distinct_approx"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name in SKETCHED:
        assert found
        return
    cursor = connect(sf_dir).execute(sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert found == canonical(columns, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(sql()) == set(QUERIES) - SKETCHED
    assert set(QUERIES) <= set(entry.queries())
    assert set(sql()) <= set(entry.oracle_sql())


def test_flagship(spark, sf_dir):
    assert entry.entry(spark).count() == 4


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_plans_stay_in_the_engine_and_join_on_keys(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|Arrow", plan)
