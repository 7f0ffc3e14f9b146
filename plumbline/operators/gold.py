"""Business aggregates over silver orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import merged_money_parts, money_parts, money_total


def revenue_parts(silver: DataFrame, *by: str) -> DataFrame:
    """Mergeable partial revenue per group: what one batch adds to gold."""
    return silver.groupBy(*by).agg(
        F.count("order_id").alias("orders"),
        *[part.alias(name) for name, part in money_parts("order_amount").items()],
    )


def _merge(parts: DataFrame, by: str) -> DataFrame:
    return parts.groupBy(by).agg(
        F.sum("orders").alias("orders"),
        *[part.alias(name) for name, part in merged_money_parts().items()],
    )


def merge_revenue_by_category(parts: DataFrame) -> DataFrame:
    return _merge(parts, "product_category").select(
        "product_category",
        money_total().alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.try_divide(money_total(), F.col("plain_values")).alias("avg_order_value"),
    )


def merge_daily_orders(parts: DataFrame) -> DataFrame:
    return (
        _merge(parts, "order_date")
        .select(
            "order_date", F.col("orders").alias("order_count"), money_total().alias("daily_revenue")
        )
        .orderBy("order_date")
    )


def revenue_by_category(silver: DataFrame) -> DataFrame:
    """Revenue, number of orders and mean order value per category.

    The merge step groups by the key the parts are already partitioned on, so
    it adds no shuffle.
    """
    return merge_revenue_by_category(revenue_parts(silver, "product_category"))


def daily_orders(silver: DataFrame) -> DataFrame:
    """Number of orders and revenue per day, sorted by day."""
    return merge_daily_orders(revenue_parts(silver, "order_date"))
