"""Fault injection on any table, its verification, and seeded sampling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import Bucket
from ..functions.numeric import rate
from ..schemas import CATEGORIES


@dataclass(frozen=True)
class Fault:
    """Replace ``column`` by ``change(column, key)`` on the rows in ``rows``."""

    column: str
    rows: Bucket
    change: Callable[[Column, Column], Column]


def null_out(column: str, rows: Bucket) -> Fault:
    return Fault(column, rows, lambda value, key: F.lit(None))


def negate(column: str, rows: Bucket) -> Fault:
    return Fault(column, rows, lambda value, key: -F.abs(value))


def move_to_future(column: str, rows: Bucket, as_of: dt.date, max_days: int = 59) -> Fault:
    """A date 1 to ``max_days`` days after ``as_of``."""
    return Fault(
        column,
        rows,
        lambda value, key: F.date_add(F.lit(as_of), (F.pmod(key, F.lit(max_days)) + 1).cast("int")),
    )


def shift_years(column: str, rows: Bucket, years: int) -> Fault:
    return Fault(column, rows, lambda value, key: F.add_months(value, 12 * years))


def replace_with(column: str, rows: Bucket, values: Sequence[str]) -> Fault:
    """One of ``values``, chosen by key."""

    def choose(value: Column, key: Column) -> Column:
        choices = F.array(*[F.lit(v) for v in values])
        return F.element_at(choices, (F.pmod(key, F.lit(len(values))) + 1).cast("int"))

    return Fault(column, rows, choose)


def repeat_key(column: str, rows: Bucket, distance: int = 1) -> Fault:
    """Take the id of the row ``distance`` keys before, for pairs of equal ids.

    Needs integer keys and ids that are the text of the key; the bucket must
    not hold both rows of a pair.
    """
    return Fault(column, rows, lambda value, key: (key - distance).cast("string"))


def inject_faults(df: DataFrame, key: str, faults: Sequence[Fault]) -> DataFrame:
    """Apply faults row by row, without a shuffle.

    Buckets of different faults are independent, so faults may meet on a row.
    """
    changed: dict[str, Column] = {}
    for fault in faults:
        value = changed.get(fault.column, F.col(fault.column))
        changed[fault.column] = F.when(
            fault.rows.holds(F.col(key)), fault.change(value, F.col(key))
        ).otherwise(value)
    typed = {name: value.cast(df.schema[name].dataType) for name, value in changed.items()}
    return df.withColumns(typed)


def fault_rates(df: DataFrame, as_of: dt.date) -> DataFrame:
    """How often each fault occurs: one row per kind of fault.

    The row-level faults need one pass and no shuffle; the repeated ids need a
    distinct count, which is kept apart so that only ids are shuffled. A NULL
    category counts as invalid, and every further row of an id as repeated.
    """
    faulty = {
        "null_payment": F.col("payment_method").isNull(),
        "negative_amount": F.col("order_amount") < 0,
        "future_date": F.col("order_date") > F.lit(as_of),
        "invalid_category": ~F.coalesce(F.col("product_category").isin(*CATEGORIES), F.lit(False)),
    }
    by_row = df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(c).alias(n) for n, c in faulty.items()]
    ).select(
        "total_rows",
        F.inline(
            F.array(
                *[F.struct(F.lit(n).alias("fault"), F.col(n).alias("faulty_rows")) for n in faulty]
            )
        ),
    )
    ids = df.groupBy("order_id").agg(F.count("*").alias("copies"))
    repeated = ids.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.lit("repeated_id").alias("fault"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("faulty_rows"),
    )
    return by_row.unionByName(repeated).select(
        "fault", "faulty_rows", "total_rows", rate(F.col("faulty_rows"), F.col("total_rows")).alias("rate")
    )


def seeded_sample(df: DataFrame, key: str, percent: float, seed: int) -> DataFrame:
    """About ``percent`` per cent of the rows, the same ones for the same seed.

    Unlike ``df.sample`` the choice depends on the key only, not on layout: by an
    MD5 digest of key and seed, so keys may follow any pattern.
    """
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.filter(F.pmod(number, F.lit(10_000)) < F.lit(round(100 * percent)))
