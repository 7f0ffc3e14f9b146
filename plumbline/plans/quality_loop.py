"""From a profile to rules to checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.checks import run_suite
from ..operators.suggest import rules_from_frame, suggest_rules


def check_suggested_rules(
    reference: DataFrame, checked: DataFrame, *, dataset_name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Suggest rules from trusted data and run them on other data.

    Only the rules reach the driver, at most five per column.
    """
    rules = rules_from_frame(suggest_rules(reference).orderBy("position", "rule_type"))
    return run_suite(checked, rules, dataset_name=dataset_name, by=by)
