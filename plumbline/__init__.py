"""Data quality and layered order analytics as Spark DataFrame plans."""

from .operators.checks import (
    Rule,
    accepted_values,
    check_schema,
    describe,
    not_null,
    null_rate_below,
    order_suite,
    run_suite,
    summarise,
    unique,
    value_range,
)
from .operators.dedup import keep_any, keep_first, upsert_by_key
from .operators.drift import (
    attribute_failures,
    batch_drift,
    failing_segments,
    failure_severity,
    root_cause_report,
)
from .operators.faults import fault_rates, inject_faults, seeded_sample
from .operators.gold import daily_orders, revenue_by_category
from .operators.profile import column_statistics, distinct_counts, profile, top_values
from .operators.responses import (
    good_rules,
    parse_root_causes,
    parse_rule_sets,
    profile_to_json,
    quarantined,
    root_cause_prompt,
    rule_prompt,
    sample_rows_json,
)
from .operators.silver import reject_rate, reject_reasons, to_silver
from .operators.suggest import rules_from_frame, rules_to_json, suggest_rules
from .plans.expectations import Expectations
from .plans.medallion import Layers, run_medallion
from .plans.quality_loop import check_suggested_rules
from .sources.history import read_history, write_history
from .sources.layers import read_orders_csv, stamp, write_csv, write_layer
from .sources.rules import read_rules, write_rules

__all__ = [name for name in dir() if not name.startswith("_")]
