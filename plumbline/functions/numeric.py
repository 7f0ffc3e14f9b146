"""Rates, rounding and exact money totals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From here on value times scale has no exact half; the fraction is rounded alone.
_SCALED = 1e12
# From here on a double is a whole number: it has no cents and no decimals.
_WHOLE = float(2**53)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL where ``whole`` is 0 (an empty input)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_to(value: Column, places: int) -> Column:
    """Round half up by plain arithmetic, so every engine gives the same value.

    Doubles of 2^53 and more are whole numbers already; they, infinities and NaN
    are returned as they are.
    """
    scale, half = F.lit(float(10**places)), F.lit(0.5)
    whole = F.floor(value)
    return (
        F.when(F.abs(value) < F.lit(_SCALED), F.floor(value * scale + half) / scale)
        .when(F.abs(value) < F.lit(_WHOLE), whole + F.floor((value - whole) * scale + half) / scale)
        .otherwise(value)
    )


def rate(part: Column, whole: Column) -> Column:
    """A share rounded to four places, as all reported rates are."""
    return round_to(ratio(part, whole), 4)


def money_parts(amount: str) -> dict[str, Column]:
    """Mergeable aggregates from which :func:`money_total` builds a total.

    The whole cents of every amount are summed in a decimal, which neither
    overflows nor depends on the order of addition; what an amount has beside
    its whole cents is summed as double. An amount without cents (NaN, an infinity,
    2^53 and more) is all remainder, and leaves the cents of the others exact.
    """
    value = F.col(amount)
    cents = F.when(F.abs(value) < F.lit(_WHOLE), F.floor(value * 100.0 + 0.5))
    return {
        "cents": F.sum(cents.cast("decimal(18,0)")).cast("decimal(38,0)"),
        "rest": F.sum(value - F.coalesce(cents / F.lit(100.0), F.lit(0.0))),
        "plain_values": F.count(value),
    }


def merged_money_parts() -> dict[str, Column]:
    """Aggregates that merge rows made by :func:`money_parts`."""
    return {
        "cents": F.sum("cents").cast("decimal(38,0)"),
        "rest": F.sum("rest"),
        "plain_values": F.sum("plain_values"),
    }


def money_total() -> Column:
    """The total over merged parts; NULL without values."""
    return F.coalesce(F.col("cents"), F.lit(0)).cast("double") / 100.0 + F.col("rest")
