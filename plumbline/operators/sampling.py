"""Samples of an exact size that do not depend on the layout."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named

DIGITS = 3  # hex digits told apart per round: 4,096 counts come back
_ORDER = "__order"


def _boundary(rows: DataFrame, wanted: int) -> tuple[str, int]:
    """A prefix of the order, and how many of the rows that begin with it belong to the ``wanted`` smallest.

    0 stands for all of them. Each round counts rows per next digits among those that still matter, so
    a round is one aggregate of at most 16^DIGITS rows and nothing is sorted.
    """
    prefix, length = "", 32
    while len(prefix) < length:
        inside = rows.filter(F.col(_ORDER).startswith(prefix)) if prefix else rows
        digits = F.substring(_ORDER, len(prefix) + 1, DIGITS)
        counts = sorted(inside.groupBy(digits.alias("digits")).agg(F.count("*").alias("rows")).collect())
        for digits, n in counts:
            if n == wanted:
                return prefix + digits, 0
            if n > wanted:
                prefix += digits
                break
            wanted -= n
    return prefix, wanted


def exact_sample(df: DataFrame, key: str, percent: float, seed: int) -> DataFrame:
    """Exactly ``percent`` per cent of the rows (half up), the same ones for the same seed.

    Rows are ordered by an MD5 digest of key and seed, and rows of one key by a digest of the whole row;
    the smallest are taken. Where the last one lies is found by a histogram of the digest that is
    refined around it, in two or three rounds for distinct keys. Rows equal in all columns
    cannot be told apart, so any of them fill the last places. A NULL key is a key.
    """
    total = df.count()
    wanted = math.floor(Fraction(str(percent)) * total / 100 + Fraction(1, 2))
    if not 0 <= wanted <= total:
        raise ValueError("percent must be from 0 to 100")
    if wanted in (0, total):
        return df if wanted else df.limit(0)
    text = F.concat(F.coalesce(named(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    taken, rows = [], df.withColumn(_ORDER, F.md5(text))
    whole = F.md5(F.to_json(F.struct(*[named(c) for c in df.columns]), {"ignoreNullFields": "false"}))
    for tie_break in (whole, None):
        prefix, places = _boundary(rows, wanted)
        shown = F.substring(_ORDER, 1, len(prefix))
        if not places:
            taken.append(rows.filter(shown <= prefix))
            break
        taken.append(rows.filter(shown < prefix))
        rows, wanted = rows.filter(shown == prefix), places
        if tie_break is None:
            taken.append(rows.limit(places))
        else:
            rows = rows.withColumn(_ORDER, tie_break)
    out = taken[0]
    for part in taken[1:]:
        out = out.unionByName(part)
    return out.drop(_ORDER)
