"""Queries over the check history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rate, ratio, round_to
from ..functions.text import label, label_part

PASS, FAIL = "PASS", "FAIL"


def to_history(
    results: DataFrame, *, first_day: dt.date | None = None, at: str = "checked_at", batch: str = "batch_id"
) -> DataFrame:
    """Suite results per batch as history rows, at the time in column ``at``.

    With ``first_day`` numbered batches are dated from that day on instead.
    """
    when = F.col(at)
    if first_day is not None:
        when = F.date_add(F.lit(first_day), F.col(batch).cast("int"))
    return results.select(
        "dataset_name",
        F.col("check_name").alias("check"),
        "column",
        F.when(F.col("success"), PASS).otherwise(FAIL).alias("status"),
        F.col("metric_value").alias("metric"),
        when.cast("timestamp").alias("timestamp"),
        F.concat(F.lit("batch_"), F.col(batch).cast("string")).alias("batch"),
    )


def kpis(history: DataFrame) -> DataFrame:
    """Checks in all, passed, failed, and the pass rate in per cent."""
    counts = history.agg(
        F.count("*").alias("total_checks"),
        F.count_if(F.col("status") == PASS).alias("passed_checks"),
        F.count_if(F.col("status") == FAIL).alias("failed_checks"),
    )
    share = ratio(F.col("passed_checks") * 100, F.col("total_checks"))
    return counts.withColumn("pass_rate", round_to(share, 1))


def listing(history: DataFrame) -> DataFrame:
    """The whole history, newest first."""
    return history.orderBy(F.desc("timestamp"), "batch", "column", "check")


def failed(history: DataFrame) -> DataFrame:
    return history.filter(F.col("status") == FAIL)


def pass_rate_trend(history: DataFrame, end: dt.date, days: int = 14) -> DataFrame:
    """Pass rate per day over the ``days`` days up to ``end``, gaps included."""
    start = end - dt.timedelta(days=days - 1)
    daily = (
        history.withColumn("day", F.to_date("timestamp"))
        .filter(F.col("day").between(F.lit(start), F.lit(end)))
        .groupBy("day")
        .agg(
            F.count("*").alias("checks"),
            rate(F.count_if(F.col("status") == PASS), F.count("*")).alias("pass_rate"),
        )
    )
    spine = history.sparkSession.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day")
    )
    # The filter leaves at most one row per day of the spine.
    return spine.join(F.broadcast(daily), "day", "left").select(
        "day", F.coalesce("checks", F.lit(0).cast("bigint")).alias("checks"), "pass_rate"
    )


def top_failing_columns(history: DataFrame) -> DataFrame:
    """Columns by number of failed checks."""
    return (
        failed(history)
        .groupBy("column")
        .agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "column")
    )


def failure_labels(history: DataFrame) -> DataFrame:
    """A selector text per failed check, and its parts read back from it."""
    text = label(F.col("batch"), F.col("column"), F.col("check"))
    return failed(history).select(
        text.alias("label"),
        label_part(text, 1).alias("label_batch"),
        label_part(text, 2).alias("label_column"),
        label_part(text, 3).alias("label_check"),
    )
