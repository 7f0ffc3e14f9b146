"""Declarative checks compiled into one aggregate per suite."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from numbers import Number
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import comparable, named, names_of
from ..functions.numeric import rate
from ..functions.values import listable, listed_value
from ..schemas import CATEGORIES, DELIVERY_STATUSES, MAX_AGE, MIN_AGE, PAYMENT_METHODS

# Rule types and the check name reported for each.
CHECK_NAMES = {
    "not_null": "expect_not_null",
    "unique": "expect_unique",
    "value_range": "expect_value_range",
    "accepted_values": "expect_accepted_values",
    "null_rate": "expect_null_rate_below",
}
RULE_TYPES = tuple(CHECK_NAMES)


@dataclass(frozen=True)
class Rule:
    """One expectation about one column."""

    rule_type: str
    column: str
    min_value: Any = None
    max_value: Any = None
    accepted: tuple | None = None
    max_null_rate: float | None = None
    reasoning: str = field(default="", compare=False)

    @property
    def check_name(self) -> str:
        return CHECK_NAMES.get(self.rule_type, self.rule_type)


def not_null(column: str) -> Rule:
    """No NULL in the column."""
    return Rule("not_null", column)


def unique(column: str) -> Rule:
    """As many distinct values as rows; NULL is one value."""
    return Rule("unique", column)


def value_range(column: str, min_value: Any = None, max_value: Any = None) -> Rule:
    """Values within closed bounds, each optional. NULL passes."""
    return Rule("value_range", column, min_value=min_value, max_value=max_value)


def accepted_values(column: str, accepted: Iterable) -> Rule:
    """Values from a list. NULL passes, unless the list is empty."""
    values = tuple(accepted)
    if any(v is None for v in values):
        raise ValueError("a NULL among the accepted values would let every value pass")
    return Rule("accepted_values", column, accepted=values)


def null_rate_below(column: str, max_null_rate: float) -> Rule:
    """The rounded share of NULL is at most ``max_null_rate``."""
    return Rule("null_rate", column, max_null_rate=float(max_null_rate))


def order_suite() -> list[Rule]:
    """Nine checks over the order columns."""
    return [
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        value_range("order_amount", min_value=0),
        value_range("customer_age", MIN_AGE, MAX_AGE),
        accepted_values("product_category", CATEGORIES),
        accepted_values("payment_method", PAYMENT_METHODS),
        accepted_values("delivery_status", DELIVERY_STATUSES),
        null_rate_below("payment_method", 0.05),
    ]


def problem_of(rule: Rule, schema: T.StructType) -> str | None:
    """Why a rule cannot be run on columns of this schema; None if it can."""
    if rule.rule_type not in CHECK_NAMES:
        return f"unknown rule type {rule.rule_type}"
    if rule.column not in schema.names:
        return f"unknown column {rule.column}"
    kind = schema[rule.column].dataType
    if rule.rule_type == "unique" and not comparable(kind):
        return f"values of type {kind.simpleString()} cannot be compared"
    if rule.rule_type == "accepted_values":
        if rule.accepted is None or None in rule.accepted:
            return "accepted must be a list without NULL"
        if not listable(kind):
            return f"no list of values for type {kind.simpleString()}"
    if rule.rule_type == "value_range":
        bounds = [b for b in (rule.min_value, rule.max_value) if b is not None]
        unfit = [b for b in bounds if not _fits(b, kind)]
        if unfit:
            return f"bound {unfit[0]!r} does not fit type {kind.simpleString()}"
    if rule.rule_type == "null_rate" and rule.max_null_rate is None:
        return "max_null_rate is missing"
    return None


def note_on(rule: Rule, schema: T.StructType) -> str | None:
    """What a rule that can be run holds that no value of its column can equal."""
    if rule.rule_type != "accepted_values" or problem_of(rule, schema) is not None:
        return None
    kind = schema[rule.column].dataType
    unfit = [v for v in rule.accepted if listed_value(v, kind) is None]
    return f"accepted value {unfit[0]!r} does not fit type {kind.simpleString()}" if unfit else None


def _fits(bound: Any, kind: T.DataType) -> bool:
    number = isinstance(bound, Number) and not isinstance(bound, bool)
    if isinstance(kind, T.NumericType):
        return number
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(bound, dt.date)
    return isinstance(kind, T.StringType) and (number or isinstance(bound, str))


def failing(rule: Rule, kind: T.DataType) -> Column:
    """True on the rows that break a rule which judges single rows."""
    column = named(rule.column)
    if rule.rule_type in ("not_null", "null_rate"):
        return column.isNull()
    if rule.rule_type == "value_range":

        def against(bound: Any) -> Column:
            if isinstance(kind, T.StringType) and isinstance(bound, Number):
                return column.try_cast("double")  # text that is no number passes like NULL
            return column

        low, high = rule.min_value, rule.max_value
        below = F.lit(False) if low is None else against(low) < F.lit(low)
        above = F.lit(False) if high is None else against(high) > F.lit(high)
        return below | above
    if rule.rule_type == "accepted_values":
        fit = [v for v in (listed_value(v, kind) for v in rule.accepted) if v is not None]
        if rule.accepted and not fit:
            return column.isNotNull()
        return ~column.isin(fit)
    raise ValueError(f"{rule.rule_type} does not judge single rows")


def _distinct(rule: Rule) -> Column:
    column = named(rule.column)
    return F.count_distinct(column) + F.coalesce(F.max(column.isNull().cast("bigint")), F.lit(0))


def _result(
    number: int, rule: Rule, measured: Column | None, message: str | None, note: str | None = None
) -> Column:
    """The result of one rule from its measured count and the row count; a note does not decide it."""
    rows = F.col("total_rows")
    success, metric, threshold = F.lit(False), F.lit(None), F.lit(None)
    if message is None:
        share = rate(measured, rows)
        success, metric, threshold = measured == 0, share, F.lit(0.0)
        if rule.rule_type == "unique":
            success, metric, threshold = measured == rows, measured, rows
        elif rule.rule_type == "null_rate":
            threshold = F.lit(rule.max_null_rate)
            success = F.coalesce(share <= threshold, F.lit(True))
    return F.struct(
        F.lit(number).alias("rule_no"),
        F.lit(rule.check_name).alias("check_name"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.rule_type).alias("rule_type"),
        success.alias("success"),
        metric.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold"),
        F.lit(message or note).cast("string").alias("message"),
    )


def _run_part(df: DataFrame, rules: list[tuple[int, Rule]], groups: Sequence[str]) -> DataFrame:
    aggregates, results = [F.count("*").alias("total_rows")], []
    for number, rule in rules:
        message = problem_of(rule, df.schema)
        if message is None:
            if rule.rule_type == "unique":
                measure = _distinct(rule)
            else:
                measure = F.count_if(failing(rule, df.schema[rule.column].dataType))
            aggregates.append(measure.alias(f"measure_{number}"))
        note = note_on(rule, df.schema)
        results.append(_result(number, rule, F.col(f"measure_{number}"), message, note))
    keys = [named(g) for g in groups]
    measured = df.groupBy(*keys).agg(*aggregates)
    return measured.select(*keys, "total_rows", F.inline(F.array(*results)))


def _run_unique(df: DataFrame, number: int, rule: Rule, groups: Sequence[str]) -> DataFrame:
    """A uniqueness rule on its own: equal values are merged before the shuffle."""
    keys = [named(g) for g in groups]
    values = df.groupBy(*keys, named(rule.column).alias("__value")).agg(F.count("*").alias("__rows"))
    measured = values.groupBy(*keys).agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("total_rows"), F.count("*").alias("__distinct")
    )
    result = _result(number, rule, F.col("__distinct"), None)
    return measured.select(*keys, "total_rows", F.inline(F.array(result)))


def run_suite(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    dataset_name: str = "dataset",
    by: str | Sequence[str] = (),
    single_scan: bool = False,
) -> DataFrame:
    """One result row per rule, or per rule and group of ``by`` (a batch, say).

    All rules that judge single rows share one aggregate without a shuffle
    (with ``by``: one small shuffle). Each uniqueness rule reads and shuffles
    its own column only, with equal values counted once per task first; mixing
    it into the shared aggregate would carry all counters along with every
    distinct value. ``single_scan`` does mix them, for inputs that are dearer to
    compute twice than to shuffle wider.

    A rule of unknown type or on an unknown column gives a failed row with a
    message, and the other rules still run. On an empty input rates are NULL
    and every rule holds.
    """
    if not rules:
        raise ValueError("a suite needs at least one rule")
    groups = names_of(by)
    numbered = list(enumerate(rules, start=1))
    alone = [
        (n, r)
        for n, r in numbered
        if r.rule_type == "unique" and problem_of(r, df.schema) is None and not single_scan
    ]
    alone_numbers = {n for n, _ in alone}
    shared = [(n, r) for n, r in numbered if n not in alone_numbers]
    parts = [_run_part(df, shared, groups)] if shared else []
    parts += [_run_unique(df, n, r, groups) for n, r in alone]
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumns(
        {"dataset_name": F.lit(dataset_name), "checked_at": F.current_timestamp()}
    )


def summarise(results: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Passed and total checks of a suite."""
    return results.groupBy(*[named(c) for c in names_of(by)]).agg(
        F.count("*").alias("total_checks"),
        F.count_if("success").alias("passed_checks"),
        F.count_if(~F.col("success")).alias("failed_checks"),
    )


def describe(results: DataFrame) -> DataFrame:
    """One readable line per result, in rule order."""
    status = F.when(F.col("success"), "PASS").otherwise("FAIL")
    line = F.concat_ws(
        " | ",
        status,
        "column",
        "rule_type",
        F.concat(F.lit("metric="), F.coalesce(F.col("metric_value").cast("string"), F.lit("none"))),
    )
    return results.orderBy("rule_no").select("rule_no", line.alias("line"))


def _converted(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value in the declared type, NULL where it does not convert."""
    if isinstance(have, T.NumericType) and isinstance(want, T.NumericType):
        return column.try_cast(want)
    if isinstance(want, T.AtomicType) and isinstance(have, T.AtomicType):
        return column.cast("string").try_cast(want)
    return F.lit(None)


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Compare a frame with its declared schema: one row per column of either.

    ``problem`` is ``missing``, ``extra``, ``wrong_type`` or NULL. For a column
    of the wrong type ``unreadable_cells`` counts the values that do not convert
    to the declared type; all columns are counted in one pass.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in contract.fields}
    aggregates, rows = [F.count("*").alias("total_rows")], []
    for i, name in enumerate([*declared, *[c for c in actual if c not in declared]]):
        have, want = actual.get(name), declared.get(name)
        problem, unreadable = None, F.lit(0)
        if have is None:
            problem = "missing"
        elif want is None:
            problem = "extra"
        elif have != want:
            problem = "wrong_type"
            column = named(name)
            broken = column.isNotNull() & _converted(column, have, want).isNull()
            aggregates.append(F.count_if(broken).alias(f"unreadable_{i}"))
            unreadable = F.col(f"unreadable_{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(want.simpleString() if want else None).cast("string").alias("declared_type"),
                F.lit(have.simpleString() if have else None).cast("string").alias("actual_type"),
                F.lit(problem).cast("string").alias("problem"),
                unreadable.cast("bigint").alias("unreadable_cells"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)), "total_rows")
