"""Checks stated one after another and run together."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame

from ..operators import checks


class Expectations:
    """Collects expectations about a frame; nothing runs until results are read.

    >>> Expectations(df, "orders").expect_not_null("order_id").results().show()
    """

    def __init__(self, df: DataFrame, dataset_name: str = "dataset") -> None:
        self._df, self._name = df, dataset_name
        self.rules: list[checks.Rule] = []

    def expect(self, *rules: checks.Rule) -> Expectations:
        self.rules.extend(rules)
        return self

    def expect_not_null(self, column: str) -> Expectations:
        return self.expect(checks.not_null(column))

    def expect_unique(self, column: str) -> Expectations:
        return self.expect(checks.unique(column))

    def expect_value_range(
        self, column: str, min_value: Any = None, max_value: Any = None
    ) -> Expectations:
        return self.expect(checks.value_range(column, min_value, max_value))

    def expect_accepted_values(self, column: str, accepted: Iterable) -> Expectations:
        return self.expect(checks.accepted_values(column, accepted))

    def expect_null_rate_below(self, column: str, max_null_rate: float) -> Expectations:
        return self.expect(checks.null_rate_below(column, max_null_rate))

    def results(self, by: str | Sequence[str] = ()) -> DataFrame:
        return checks.run_suite(self._df, self.rules, dataset_name=self._name, by=by)

    def summary(self, by: str | Sequence[str] = ()) -> DataFrame:
        return checks.summarise(self.results(by), by)
