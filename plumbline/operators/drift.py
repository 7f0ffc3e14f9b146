"""Change between batches, severity, and where failing rows come from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import named, names_of
from ..functions.numeric import rate, ratio, round_to
from ..functions.text import percent, severity_marker
from .checks import Rule, failing, problem_of


def batch_drift(results: DataFrame, *, first_day: dt.date, batch: str = "batch_id") -> DataFrame:
    """Every check of every batch beside the same check of the batch before.

    The compared level is the metric; uniqueness is compared as the share of
    distinct values, since counts change with the size of a batch. Batches are
    dated from ``first_day`` on. The window holds one row per batch.
    """
    order = W.partitionBy("dataset_name", "rule_no", "column", "check_name").orderBy(batch)
    level = F.when(
        F.col("rule_type") == "unique", rate(F.col("metric_value"), F.col("total_rows"))
    ).otherwise(F.col("metric_value"))
    dated = results.withColumns(
        {"level": level, "batch_date": F.date_add(F.lit(first_day), F.col(batch).cast("int"))}
    )
    before = dated.withColumns(
        {
            "previous_level": F.lag("level").over(order),
            "previous_rows": F.lag("total_rows").over(order),
            "previous_date": F.lag("batch_date").over(order),
        }
    )
    return before.withColumn("change", round_to(F.col("level") - F.col("previous_level"), 4))


def failure_severity(drift: DataFrame, *, high: float = 0.20, medium: float = 0.05) -> DataFrame:
    """Failed checks graded by how much worse they are than in the batch before.

    A check that failed in its first batch has no change and is MEDIUM.
    """
    worse = F.when(F.col("rule_type") == "unique", -F.col("change")).otherwise(F.col("change"))
    grade = (
        F.when(worse.isNull(), "MEDIUM")
        .when(worse >= high, "HIGH")
        .when(worse >= medium, "MEDIUM")
        .otherwise("LOW")
    )
    return drift.filter(~F.col("success")).withColumn("severity", grade)


def failing_segments(
    df: DataFrame,
    rules: Sequence[Rule],
    dimensions: Sequence[str],
    by: str | Sequence[str] = (),
) -> DataFrame:
    """Failing rows per value of each dimension, for all rules in one pass.

    ``share`` is the part of a rule's failing rows with that value, ``lift`` how
    much more often those rows fail than all rows. Rows are counted per value
    before the shuffle, so what is shuffled grows with the number of values,
    not of rows. The failing rows of a uniqueness rule are those whose value
    repeats; they are found by counting values once more for each such rule.
    Rules that cannot run are left out. With ``by``, shares and lifts are those
    within each group (a batch, say), and values repeat within it.
    """
    by = names_of(by)
    runnable = [(n, r) for n, r in enumerate(rules, start=1) if problem_of(r, df.schema) is None]
    judged = [(n, r) for n, r in runnable if r.rule_type != "unique"]
    unique = [(n, r) for n, r in runnable if r.rule_type == "unique"]
    if not runnable:
        raise ValueError("none of the rules can be run")
    flags = {f"fails_{n}": failing(r, df.schema[r.column].dataType) for n, r in judged}
    groups = [f"by_{i}" for i, _ in enumerate(by)]
    # One row per dimension, made by a generator: unpivoting keeps the ids of
    # the other columns, which hides from Spark that the two uses below are one.
    values = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), named(c).cast("string").alias("value"))
            for c in dimensions
        ]
    )
    counts = (
        df.select(
            *[named(c).alias(g) for c, g in zip(by, groups)],
            *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
            F.inline(values),
        )
        .groupBy(*groups, "dimension", "value")
        .agg(F.count("*").alias("rows"), *[F.count_if(name).alias(name) for name in flags])
    )
    for n, rule in unique:
        repeated = _repeated_rows(df, rule, dimensions, values, by, groups).withColumnRenamed("rows", f"fails_{n}")
        at = [*groups, "dimension", "value"]
        repeated = repeated.select(*[F.col(c).alias(f"at_{c}") for c in at], f"fails_{n}")
        same = [F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in at]
        counts = (
            counts.join(repeated, reduce(lambda a, b: a & b, same), "left")
            .withColumn(f"fails_{n}", F.coalesce(f"fails_{n}", F.lit(0)))
            .drop(*[f"at_{c}" for c in at])
        )
    per_rule = F.array(
        *[
            F.struct(F.lit(n).alias("rule_no"), F.col(f"fails_{n}").alias("failing_rows"))
            for n, _ in runnable
        ]
    )
    long = counts.select(*groups, "dimension", "value", "rows", F.inline(per_rule))
    totals = long.groupBy(
        *[F.col(c).alias(f"all_{c}") for c in (*groups, "dimension", "rule_no")]
    ).agg(F.sum("rows").alias("all_rows"), F.sum("failing_rows").alias("all_failing"))
    if not by:
        totals = F.broadcast(totals)  # one row per dimension and rule
    # NULL-safe, so that a NULL group is kept. Both sides start from the same
    # counts, whose shuffle is shared.
    same = (F.col("dimension") == F.col("all_dimension")) & (F.col("rule_no") == F.col("all_rule_no"))
    for column in groups:
        same = same & F.col(column).eqNullSafe(F.col(f"all_{column}"))
    joined = long.filter(F.col("failing_rows") > 0).join(totals, same)
    own = ratio(F.col("failing_rows"), F.col("rows"))
    overall = ratio(F.col("all_failing"), F.col("all_rows"))
    return joined.select(
        *[F.col(g).alias(c) for c, g in zip(by, groups)],
        "rule_no",
        "dimension",
        "value",
        "rows",
        "failing_rows",
        rate(F.col("failing_rows"), F.col("all_failing")).alias("share"),
        round_to(F.try_divide(own, overall), 4).alias("lift"),
    )


def _repeated_rows(
    df: DataFrame, rule: Rule, dimensions: Sequence[str], values: Column, by: Sequence[str], groups: Sequence[str]
) -> DataFrame:
    """Rows whose value of a unique column repeats, per value of each dimension.

    Equal rows (in that column and the dimensions) are counted before any shuffle.
    """
    keys = [*[named(c).alias(g) for c, g in zip(by, groups)], named(rule.column).alias("checked")]
    cells = df.groupBy(*keys, *[named(d) for d in dimensions]).agg(F.count("*").alias("cell_rows"))
    often = (
        cells.groupBy(*groups, "checked")
        .agg(F.sum("cell_rows").alias("times"))
        .filter("times > 1")
        .select(*[F.col(c).alias(f"often_{c}") for c in (*groups, "checked")])
    )
    same = [F.col(c).eqNullSafe(F.col(f"often_{c}")) for c in (*groups, "checked")]
    found = cells.join(often, reduce(lambda a, b: a & b, same), "left_semi")
    return (
        found.select(*groups, "cell_rows", F.inline(values))
        .groupBy(*groups, "dimension", "value")
        .agg(F.sum("cell_rows").alias("rows"))
    )


def attribute_failures(
    df: DataFrame, rule: Rule, dimensions: Sequence[str], k: int = 10
) -> DataFrame:
    """The ``k`` dimension values in which a rule fails most out of proportion."""
    order = [
        F.desc("lift"),
        F.desc("failing_rows"),
        F.asc("dimension"),
        F.asc_nulls_last("value"),
    ]
    best = failing_segments(df, [rule], dimensions).drop("rule_no").orderBy(*order).limit(k)
    # At most k rows are left to be numbered.
    return best.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))


def root_cause_report(failures: DataFrame, segments: DataFrame, batch: str = "batch_id") -> DataFrame:
    """A record per failed check: what changed, and the segment it is bound to.

    The confidence is the share of the failing rows in the leading segment, 0
    where no rows can be named.
    """
    order = W.partitionBy(batch, "rule_no").orderBy(
        F.desc("lift"), F.desc("failing_rows"), F.asc("dimension"), F.asc_nulls_last("value")
    )
    leading = (
        segments.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") == 1)
        .select(
            F.col(batch).alias("place_batch"),
            F.col("rule_no").alias("place_rule"),
            "dimension",
            "value",
            "share",
        )
    )
    same = F.col(batch).eqNullSafe(F.col("place_batch")) & (F.col("rule_no") == F.col("place_rule"))
    segment = F.concat(F.col("dimension"), F.lit(" "), F.coalesce("value", F.lit("NULL")))
    change = F.when(
        F.col("previous_level").isNull(),
        F.concat(F.lit("is "), percent(F.col("level")), F.lit(" in the first batch")),
    ).otherwise(
        F.concat(
            F.lit("went from "), percent(F.col("previous_level")), F.lit(" to "), percent(F.col("level"))
        )
    )
    where = F.when(
        F.col("share").isNotNull(),
        F.concat(
            F.lit("; "),
            segment,
            F.lit(" holds "),
            percent(F.col("share")),
            F.lit(" of the failing rows"),
        ),
    ).otherwise(F.lit(""))
    metric = F.when(F.col("rule_type") == "unique", "distinct share").otherwise("failing share")
    return failures.join(leading, same, "left").select(
        batch,
        F.col("check_name").alias("failed_check"),
        "column",
        F.concat(metric, F.lit(" of "), F.col("column"), F.lit(" "), change, where).alias("explanation"),
        F.coalesce("share", F.lit(0.0)).alias("confidence"),
        F.concat(
            F.lit("check the load of "),
            F.col("batch_date").cast("string"),
            F.when(F.col("share").isNotNull(), F.concat(F.lit(" for "), segment)).otherwise(F.lit("")),
        ).alias("recommended_investigation"),
        "severity",
        severity_marker(F.col("severity")).alias("marker"),
    )
