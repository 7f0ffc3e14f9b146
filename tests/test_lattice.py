"""Combinations of dimension values against counting every one."""

from __future__ import annotations

import itertools
import random

import pytest

from plumbline import not_null, unique, value_range
from plumbline.operators import lattice
from plumbline.operators.checks import Rule
from plumbline.operators.drift import failing_segments
from plumbline.operators.lattice import failing_combinations

SCHEMA = "batch long, a string, b int, `c.d` string, id string, amount double"
DIMENSIONS = ["a", "b", "c.d"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(400):
        a, b, c = rng.choice(["x", "y", "z", None, "", "n"]), rng.choice([1, 2, None]), rng.choice(["p", "q and r", "NULL"])
        bad = a == "x" and b == 2 or rng.random() < 0.05
        out.append((rng.choice([0, 1, None]), a, b, c, f"id{i // 2 if bad else i + 1000}", -1.0 if bad else rng.choice([1.0, None])))
    return out


def counted(rows, least, sizes, by_batch):
    """(batch, rule, names, values) to rows, failing rows, and the rule's rows and failing rows."""
    out = {}
    groups = {r[0] if by_batch else 0 for r in rows}
    for group in groups:
        part = [r for r in rows if not by_batch or r[0] == group]
        times = {r[4]: sum(x[4] == r[4] for x in part) for r in part}
        flags = {1: [times[r[4]] > 1 for r in part], 2: [r[5] is not None and r[5] < 0 for r in part], 4: [r[5] is None for r in part]}
        for n, flag in flags.items():
            for size in sizes:
                for where in itertools.combinations(range(3), size):
                    found = {}
                    for r, bad in zip(part, flag):
                        cell = found.setdefault(tuple(r[1 + i] for i in where), [0, 0])
                        cell[0] += 1
                        cell[1] += bad
                    for values, (total, failing) in found.items():
                        if failing >= max(1, least):
                            out[group, n, where, values] = (total, failing, round(failing / sum(flag) + 1e-9, 4))
    return out


RULES = [unique("id"), value_range("amount", min_value=0), Rule("regex", "id"), not_null("amount")]


@pytest.mark.parametrize("least,most,by", [(1, None, ["batch"]), (5, None, []), (12, 2, ["batch"]), (10_000, None, [])])
def test_equals_counting_every_combination(spark, rows, least, most, by):
    found = failing_combinations(spark.createDataFrame(rows, SCHEMA), RULES, DIMENSIONS, by, min_failing=least, max_dimensions=most)
    wanted = {}
    for (group, n, where, values), numbers in counted(rows, least, range(1, (most or 3) + 1), bool(by)).items():
        shown = None if values[0] is None else str(values[0])
        if len(values) > 1:
            shown = " and ".join("NULL" if v is None else str(v) for v in values)
        key = (group if by else 0, n, " and ".join(DIMENSIONS[i] for i in where), shown)
        wanted.setdefault(key, []).append((len(where), *numbers))
    got = {}
    for r in found.collect():
        key = (r["batch"] if by else 0, r.rule_no, r.dimension, r.value)
        got.setdefault(key, []).append((r.dimensions, r.rows, r.failing_rows, r.share))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_single_dimensions_equal_the_segments(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ["rule_no", "dimension", "value", "rows", "failing_rows", "share", "lift"]
    single = failing_combinations(df, RULES, DIMENSIONS, max_dimensions=1).select(columns).collect()
    assert sorted(single, key=repr) == sorted(failing_segments(df, RULES, DIMENSIONS).select(columns).collect(), key=repr)


def test_a_level_counts_only_what_its_parts_support(spark, rows, monkeypatch):
    """Of rows in which ``x`` and 2 fail together, the levels above hold these alone."""
    stored = {}
    real = lattice.write_layer

    def noted(df, path):
        out = real(df, path)
        stored[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] = out
        return out

    monkeypatch.setattr(lattice, "write_layer", noted)
    failing_combinations(spark.createDataFrame(rows, SCHEMA), [value_range("amount", min_value=0)], DIMENSIONS, min_failing=15).collect()
    opened = stored["lattice-open-1"].collect()
    assert 0 < len(opened) < stored["lattice-cells"].count() or all(len(r["open"]) for r in opened)
    singles = {tuple(r["values"]) for r in stored["lattice-1"].collect()}
    for r in stored["lattice-2"].collect():
        for i in range(3):
            if r["values"][i]:
                assert tuple(v if j == i else "" for j, v in enumerate(r["values"])) in singles


def test_refusals_and_empty_input(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(ValueError):
        failing_combinations(df, [Rule("regex", "id")], DIMENSIONS)
    with pytest.raises(ValueError):
        failing_combinations(df, RULES, [])
    assert failing_combinations(spark.createDataFrame([], SCHEMA), RULES, DIMENSIONS).count() == 0
