"""Refining raw orders: deduplicate, then keep only valid rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import rate
from ..schemas import (
    CATEGORIES,
    DELIVERY_STATUSES,
    MAX_AGE,
    MIN_AGE,
    PAYMENT_METHODS,
    TRANSFORMED_AT,
)
from .dedup import keep_any, keep_first, total_order

VERDICT, REASONS = "verdict", "reasons"
ACCEPTED, REJECTED = "accepted", "rejected"


def survivor_order(df: DataFrame) -> list[Column]:
    """A total order over the copies of one order, largest amount first.

    Any column not named here (a source key, say) breaks the remaining ties.
    """
    named = ["order_amount", "order_date", "product_category", "payment_method", "customer_id"]
    other = {*named, "order_id", "ingested_at", TRANSFORMED_AT}
    rest = [f for f in df.schema.fields if f.name not in other]
    return [
        F.col("order_amount").desc_nulls_last(),
        F.col("order_date").asc_nulls_first(),
        F.col("product_category").asc_nulls_first(),
        F.col("payment_method").asc_nulls_last(),
        F.col("customer_id").asc_nulls_first(),
        *[total_order(f).asc_nulls_first() for f in rest],
    ]


def deduplicate_orders(
    df: DataFrame,
    *,
    key: str = "order_id",
    order: Sequence[Column] | None = None,
    any_survivor: bool = False,
) -> DataFrame:
    if any_survivor:
        return keep_any(df, [key])
    return keep_first(df, [key], order or survivor_order(df))


def silver_conditions(as_of: dt.date | None = None) -> dict[str, Column]:
    """What a valid order fulfils. A NULL fulfils nothing and is rejected."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return {
        "order_amount": F.col("order_amount") > 0,
        "order_date": F.col("order_date") <= today,
        "product_category": F.col("product_category").isin(*CATEGORIES),
        "payment_method": F.col("payment_method").isin(*PAYMENT_METHODS),
        "delivery_status": F.col("delivery_status").isin(*DELIVERY_STATUSES),
        "customer_age": F.col("customer_age").between(MIN_AGE, MAX_AGE),
    }


def valid_orders(deduplicated: DataFrame, *, as_of: dt.date | None = None) -> DataFrame:
    """Filter, round the amount to cents and stamp already deduplicated orders."""
    kept = deduplicated
    for condition in silver_conditions(as_of).values():
        kept = kept.filter(condition)
    return kept.withColumns(
        {"order_amount": F.round("order_amount", 2), TRANSFORMED_AT: F.current_timestamp()}
    )


def to_silver(
    df: DataFrame,
    *,
    as_of: dt.date | None = None,
    key: str = "order_id",
    order: Sequence[Column] | None = None,
    any_survivor: bool = False,
) -> DataFrame:
    """Raw orders to silver orders.

    Deduplication comes first: an id whose surviving copy is invalid is gone,
    even if another copy was valid. ``as_of`` replaces today's date.
    """
    unique = deduplicate_orders(df, key=key, order=order, any_survivor=any_survivor)
    return valid_orders(unique, as_of=as_of)


def judge_orders(deduplicated: DataFrame, *, as_of: dt.date | None = None) -> DataFrame:
    """Every deduplicated order with its ``verdict`` and the ``reasons`` it was rejected for, in the order of the conditions.

    Accepted orders are those of ``valid_orders``, rounded as there; rejected ones stay as they came.
    """
    failed = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in silver_conditions(as_of).items()
    ]
    judged = deduplicated.withColumn(REASONS, F.array_compact(F.array(*failed)))
    accepted = F.size(REASONS) == 0
    return judged.withColumns(
        {
            VERDICT: F.when(accepted, ACCEPTED).otherwise(REJECTED),
            "order_amount": F.when(accepted, F.round("order_amount", 2)).otherwise(F.col("order_amount")),
            TRANSFORMED_AT: F.current_timestamp(),
        }
    )


def write_verdicts(judged: DataFrame, path: str) -> DataFrame:
    """Store judged orders once, in a folder per verdict, and go on from the stored files.

    Both outputs come from one pass; ``accepted`` and ``rejected`` read their own folder only.
    """
    judged.write.mode("overwrite").partitionBy(VERDICT).parquet(path)
    columns = [f for f in judged.schema.fields if f.name != VERDICT]
    schema = T.StructType([*columns, T.StructField(VERDICT, T.StringType())])
    return judged.sparkSession.read.schema(schema).parquet(path)


def accepted(judged: DataFrame) -> DataFrame:
    """The silver layer of judged orders."""
    return judged.filter(F.col(VERDICT) == ACCEPTED).drop(VERDICT, REASONS)


def rejected(judged: DataFrame) -> DataFrame:
    """The rejected orders, each with its reasons."""
    return judged.filter(F.col(VERDICT) == REJECTED).drop(VERDICT)


def reject_rate(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts of both layers and the rejected share, as one row."""
    counts = bronze.agg(F.count("*").alias("bronze_rows"), F.lit(0).cast("bigint").alias("silver_rows"))
    counts = counts.unionByName(
        silver.agg(F.lit(0).cast("bigint").alias("bronze_rows"), F.count("*").alias("silver_rows"))
    )
    total = counts.agg(
        F.sum("bronze_rows").alias("bronze_rows"), F.sum("silver_rows").alias("silver_rows")
    )
    rejected = F.col("bronze_rows") - F.col("silver_rows")
    return total.withColumn("reject_rate", rate(rejected, F.col("bronze_rows")))


def reject_reasons(
    df: DataFrame, *, as_of: dt.date | None = None, order: Sequence[Column] | None = None
) -> DataFrame:
    """Deduplicated rows failing each condition, and failing any.

    A row may fail several conditions; NULL fails, as in the filter.
    """
    failing = {
        name: ~F.coalesce(condition, F.lit(False))
        for name, condition in silver_conditions(as_of).items()
    }
    any_failing = F.lit(False)
    for condition in failing.values():
        any_failing = any_failing | condition
    failing["any"] = any_failing
    counts = deduplicate_orders(df, order=order).agg(
        F.count("*").alias("rows"), *[F.count_if(c).alias(name) for name, c in failing.items()]
    )
    reasons = F.array(
        *[
            F.struct(F.lit(name).alias("reason"), F.col(name).alias("rejected_rows"))
            for name in failing
        ]
    )
    return (
        counts.select("rows", F.inline(reasons))
        .withColumn("share", rate(F.col("rejected_rows"), F.col("rows")))
        .select("reason", "rejected_rows", "share")
    )
