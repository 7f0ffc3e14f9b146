"""Batch run from raw orders to gold tables and a profile."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.gold import daily_orders, revenue_by_category
from ..operators.profile import profile
from ..operators.silver import to_silver
from ..sources.layers import stamp, write_layer


@dataclass(frozen=True)
class Layers:
    """Stored layers, each read back from its files."""

    bronze: DataFrame
    silver: DataFrame
    revenue_by_category: DataFrame
    daily_orders: DataFrame
    profile: DataFrame


def run_medallion(
    raw: DataFrame, root: str, *, as_of: dt.date | None = None, fmt: str = "parquet"
) -> Layers:
    """Store bronze, silver, gold and the silver profile below ``root``.

    Every step reads the files of the step before: the raw input is read once,
    and all layers come from the same surviving rows.
    """
    bronze = write_layer(stamp(raw), f"{root}/bronze", fmt=fmt)
    silver = write_layer(to_silver(bronze, as_of=as_of), f"{root}/silver", fmt=fmt)
    revenue = write_layer(revenue_by_category(silver), f"{root}/gold/revenue_by_category", fmt=fmt)
    daily = write_layer(daily_orders(silver), f"{root}/gold/daily_orders", fmt=fmt)
    profiled = write_layer(profile(silver), f"{root}/profile", fmt=fmt)
    return Layers(bronze, silver, revenue, daily.orderBy("order_date"), profiled)
