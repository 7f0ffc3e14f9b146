"""Which combinations of dimension values failing rows are bound to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, names_of
from ..functions.numeric import rate, ratio, round_to
from ..session import work_path
from ..sources.layers import write_layer
from .checks import Rule, failing, problem_of

MOST_DIMENSIONS = 10
AND = " and "


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """All pairs of columns equal, NULL with NULL."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _names(by: Sequence[str], dimensions: Sequence[str]) -> tuple[list[str], list[str]]:
    """Working names of the groups (one for all rows where none are given) and the dimensions."""
    return [f"by_{i}" for i in range(max(1, len(by)))], [f"d_{i}" for i, _ in enumerate(dimensions)]


def _cells(df: DataFrame, rules: Sequence[tuple[int, Rule]], dimensions: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows and failing rows of each rule per combination of all dimension values that occurs.

    Rows are merged per task before the shuffle. Values are texts: ``v`` and the value, or ``n`` for NULL.
    """
    groups, places = _names(by, dimensions)
    keys = [named(c).alias(g) for c, g in zip(by, groups)] or [F.lit(0).alias(groups[0])]
    keys += [F.coalesce(F.concat(F.lit("v"), named(c).cast("string")), F.lit("n")).alias(p) for c, p in zip(dimensions, places)]
    judged = [(n, r) for n, r in rules if r.rule_type != "unique"]
    flags = {f"fails_{n}": F.coalesce(failing(r, df.schema[r.column].dataType), F.lit(False)) for n, r in judged}
    cells = (
        df.select(*keys, *[flag.alias(name) for name, flag in flags.items()])
        .groupBy(*groups, *places)
        .agg(F.count("*").alias("rows"), *[F.count_if(name).alias(name) for name in flags])
    )
    for n, rule in rules:
        if rule.rule_type == "unique":
            cells = _with_repeated(cells, df.select(*keys, named(rule.column).alias("checked")), n, groups, places)
    return cells


def _with_repeated(cells: DataFrame, rows: DataFrame, number: int, groups: list[str], places: list[str]) -> DataFrame:
    """Adds the rows whose value repeats within its group; equal rows are merged before any shuffle."""
    counted = rows.groupBy(*groups, *places, "checked").agg(F.count("*").alias("times"))
    often = counted.groupBy(*groups, "checked").agg(F.sum("times").alias("all_times")).filter("all_times > 1")
    at = [*groups, "checked"]
    often = often.select(*[F.col(c).alias(f"often_{c}") for c in at])
    repeated = counted.join(often, _same(at, [f"often_{c}" for c in at]), "left_semi")
    keys = [*groups, *places]
    repeated = repeated.groupBy(*[F.col(c).alias(f"at_{c}") for c in keys]).agg(F.sum("times").alias(f"fails_{number}"))
    return (
        cells.join(repeated, _same(keys, [f"at_{c}" for c in keys]), "left")
        .withColumn(f"fails_{number}", F.coalesce(f"fails_{number}", F.lit(0)))
        .drop(*[f"at_{c}" for c in keys])
    )


def _open_sets(size: int, dimensions: int) -> Column:
    """The sets of ``size`` dimensions of a cell all of whose subsets of one less are supported there.

    A set is a bit mask; ``open`` holds the supported masks of the level before.
    """

    def mask(members: Sequence[int]) -> int:
        return sum(1 << i for i in members)

    sets = []
    for members in combinations(range(dimensions), size):
        held = [F.array_contains("open", mask(part)) for part in combinations(members, size - 1) if size > 1]
        sets.append(F.when(reduce(lambda a, b: a & b, held, F.lit(True)), F.lit(mask(members))))
    return F.array_compact(F.array(*sets))


def failing_combinations(
    df: DataFrame,
    rules: Sequence[Rule],
    dimensions: Sequence[str],
    by: str | Sequence[str] = (),
    *,
    min_failing: int = 1,
    max_dimensions: int | None = None,
) -> DataFrame:
    """Failing rows per combination of values of one, two and more dimensions.

    One row per rule and combination with ``min_failing`` failing rows or more, in the columns of
    ``failing_segments`` (names and values of several dimensions joined by "and") with ``dimensions``, how many
    there are. ``share`` and ``lift`` are those within each group of ``by``.

    Level by level, as frequent sets are searched: a combination can only have the failing rows
    that each of its parts has, so a level counts the combinations all of whose parts were supported and no
    others. The data is read once, into the cells of all dimensions; each level is one aggregate over the cells
    that still have supported parts, which are stored for the next. Rules that cannot run are left out.
    """
    by = names_of(by)
    if not 1 <= len(dimensions) <= MOST_DIMENSIONS:
        raise ValueError(f"give 1 to {MOST_DIMENSIONS} dimensions")
    rules = [(n, r) for n, r in enumerate(rules, start=1) if problem_of(r, df.schema) is None]
    if not rules:
        raise ValueError("none of the rules can be run")
    spark, fails = df.sparkSession, [f"fails_{n}" for n, _ in rules]
    groups, places = _names(by, dimensions)
    # Numbered as stored, so that the numbers stay.
    numbered = _cells(df, rules, dimensions, by).withColumn("cell", F.monotonically_increasing_id())
    cells = write_layer(numbered, work_path(spark, "lattice-cells"))
    totals = cells.groupBy(*[F.col(g).alias(f"all_{g}") for g in groups]).agg(
        F.sum("rows").alias("all_rows"), *[F.sum(f).alias(f"all_{f}") for f in fails]
    )
    levels, key = [], [*groups, "mask", "values"]
    active = cells.withColumn("open", F.array().cast("array<int>"))
    for size in range(1, min(max_dimensions or len(dimensions), len(dimensions)) + 1):
        values = F.array(*[F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.col(p)).otherwise("") for i, p in enumerate(places)])
        parts = active.withColumn("mask", F.explode(_open_sets(size, len(dimensions)))).withColumn("values", values)
        counted = parts.groupBy(*key).agg(F.sum("rows").alias("rows"), *[F.sum(f).alias(f) for f in fails])
        supported = counted.filter(F.greatest(F.lit(0), *fails) >= min_failing)
        supported = write_layer(supported, work_path(spark, f"lattice-{size}"))
        levels.append(supported)
        if size == len(dimensions) or supported.isEmpty():
            break
        names = supported.select(*[F.col(c).alias(f"is_{c}") for c in key])
        left = parts.join(names, _same(key, [f"is_{c}" for c in key]), "left_semi")
        left = left.groupBy(F.col("cell").alias("of_cell")).agg(F.collect_set("mask").alias("open"))
        active = cells.join(left, F.col("cell") == F.col("of_cell")).drop("of_cell")
        active = write_layer(active, work_path(spark, f"lattice-open-{size}"))
    found = reduce(DataFrame.union, levels)
    per_rule = F.array(
        *[
            F.struct(F.lit(n).alias("rule_no"), F.col(f"fails_{n}").alias("failing_rows"), F.col(f"all_fails_{n}").alias("all_failing"))
            for n, _ in rules
        ]
    )
    joined = found.join(totals, _same(groups, [f"all_{g}" for g in groups]))
    long = joined.select(*groups, "mask", "values", "rows", "all_rows", F.inline(per_rule))
    inside = F.filter(F.col("values"), lambda v: v != "")
    texts = F.transform(inside, lambda v: F.when(v == "n", F.lit(None)).otherwise(F.substring(v, 2, 1 << 30)))
    names = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.lit(d)) for i, d in enumerate(dimensions)]))
    overall = ratio(F.col("all_failing"), F.col("all_rows"))
    # A single NULL stays NULL, as in failing_segments.
    value = F.when(F.size(texts) == 1, texts[0]).otherwise(F.array_join(texts, AND, "NULL"))
    return long.filter((F.col("failing_rows") >= min_failing) & (F.col("failing_rows") > 0)).select(
        *[F.col(g).alias(c) for c, g in zip(by, groups)],
        "rule_no",
        F.size(names).alias("dimensions"),
        F.array_join(names, AND).alias("dimension"),
        value.alias("value"),
        "rows",
        "failing_rows",
        rate(F.col("failing_rows"), F.col("all_failing")).alias("share"),
        round_to(F.try_divide(ratio(F.col("failing_rows"), F.col("rows")), overall), 4).alias("lift"),
    )
