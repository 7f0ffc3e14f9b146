"""Listed values in the type of the column they are compared with."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", re.ASCII)
_DAY = re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})", re.ASCII)
#: Bits of the integer types.
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_NOT_FINITE = {"nan": math.nan, "infinity": math.inf, "inf": math.inf, "-infinity": -math.inf, "-inf": -math.inf}


def listable(kind: T.DataType) -> bool:
    """Whether values of this type can be given as a list."""
    return isinstance(
        kind, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


def _number(value: Any) -> decimal.Decimal | float | None:
    """The exact number a value or text stands for; infinities and NaN as float."""
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal, str)):
        return None
    text = str(value).strip()
    if text.lower() in _NOT_FINITE:
        return _NOT_FINITE[text.lower()]
    if not _NUMBER.fullmatch(text):
        return None
    try:
        number = decimal.Decimal(text)
    except decimal.InvalidOperation:
        return None
    return number if abs(number.adjusted()) < 400 else None


def _moment(value: Any) -> dt.datetime | None:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime.combine(value, dt.time())
    if not isinstance(value, str):
        return None
    text = value.strip()
    try:
        if day := _DAY.fullmatch(text):
            return dt.datetime(*map(int, day.groups()))
        return dt.datetime.fromisoformat(text)
    except ValueError:
        return None


def listed_value(value: Any, kind: T.DataType) -> Column | None:
    """A listed value as a column of type ``kind``; None if no value of that type equals it.

    Values are given as such or as text. A number must survive the type exactly: 1.0 and "1e0" are an integer, 1.5 is
    none, 1.504 is no decimal of two places, and 300 is no byte. Floating types take the nearest
    double. A day is written as ``2024-01-31`` or in any ISO form, a moment in ISO form. Nothing raises
    and nothing is rounded to a value that was not listed.
    """
    if isinstance(kind, T.StringType):
        return F.lit(value).cast(kind)
    if isinstance(kind, T.BooleanType):
        truth = {"true": True, "false": False}.get(str(value).strip().lower())
        return None if truth is None else F.lit(truth)
    if isinstance(kind, T.NumericType):
        number = _number(value)
        if number is None:
            return None
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            nearest = float(number)
            overflows = math.isinf(nearest) and isinstance(number, decimal.Decimal)
            return None if overflows else F.lit(nearest).cast(kind)
        if isinstance(number, float):
            return None
        if isinstance(kind, T.DecimalType):
            scaled = number.scaleb(kind.scale, decimal.Context(prec=1000))
            if scaled != scaled.to_integral_value() or abs(scaled) >= 10**kind.precision:
                return None
            return F.lit(format(number, "f")).cast(kind)
        whole, limit = number.to_integral_value(), 1 << _BITS[type(kind)] - 1
        return F.lit(int(whole)).cast(kind) if whole == number and -limit <= whole < limit else None
    moment = _moment(value)
    if moment is None:
        return None
    if isinstance(kind, T.DateType):
        midnight = moment.time() == dt.time() and moment.tzinfo is None
        return F.lit(moment.date().isoformat()).cast(kind) if midnight else None
    if isinstance(kind, T.TimestampNTZType) and moment.tzinfo is not None:
        return None
    return F.lit(moment.isoformat(sep=" ")).cast(kind)
