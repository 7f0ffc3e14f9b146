"""Rules suggested from a profile, and rules as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RULES
from ..session import work_path
from ..sources.layers import write_layer
from .checks import Rule
from .profile import profile, top_values

# A text column is taken for a list if its distinct values are at most this share of its rows,
LISTED_SHARE = 0.01
# and as many as a rule, which is one row and one condition, can hold.
MAX_LISTED = 10_000


def _rule(rule_type: str, reasoning: Column, **parameters: Column) -> Column:
    values = {
        "column": F.col("column"),
        "rule_type": F.lit(rule_type),
        **{p: F.lit(None) for p in ("min_value", "max_value", "accepted", "max_null_rate")},
        **parameters,
        "reasoning": reasoning,
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in RULES.fields])


def _few(distinct: Column, total: Column, share: float, most: int) -> Column:
    return (distinct <= share * total) & (distinct <= most)


def suggest_from_profile(
    profiled: DataFrame, *, listed_share: float = LISTED_SHARE, max_listed: int = MAX_LISTED
) -> DataFrame:
    """Rules that the profiled data fulfils, as rows of the rule schema.

    A list of values is only proposed where the profile holds all of them, they are at most
    ``listed_share`` of the rows, and no more than ``max_listed``. All heuristics look at the
    same profile row, so the profile is computed once.
    """
    total, nulls = F.col("total_rows"), F.col("null_count")
    distinct, listed = F.col("distinct_count"), F.filter("top_values", lambda v: v.isNotNull())
    # A list that leaves out a value would be a rule that its own data breaks.
    complete = F.size(listed) == distinct - (nulls > 0).cast("int")
    ceiling = F.ceil(F.try_divide(nulls * 100, total)) / 100
    count = F.format_string("%d rows", total)
    candidates = [
        F.when(nulls == 0, _rule("not_null", F.concat(F.lit("no NULL in "), count))),
        F.when(
            nulls > 0,
            _rule(
                "null_rate",
                F.concat(nulls.cast("string"), F.lit(" NULL in "), count),
                max_null_rate=ceiling,
            ),
        ),
        F.when(
            distinct == total, _rule("unique", F.concat(F.lit("every value differs in "), count))
        ),
        F.when(
            F.col("lowest").isNotNull(),
            _rule(
                "value_range",
                F.concat(F.lit("bounds seen in "), count),
                min_value=F.col("lowest"),
                max_value=F.col("highest"),
            ),
        ),
        F.when(
            complete & _few(distinct, total, listed_share, max_listed) & (F.size(listed) > 0),
            _rule(
                "accepted_values",
                F.concat(distinct.cast("string"), F.lit(" distinct values in "), count),
                accepted=F.array_sort(listed),
            ),
        ),
    ]
    rules = F.filter(F.array(*candidates), lambda r: r.isNotNull())
    return profiled.filter(total > 0).select("position", F.inline(rules))


def suggest_rules(df: DataFrame, *, listed_share: float = LISTED_SHARE, max_listed: int = MAX_LISTED) -> DataFrame:
    """Profile a frame and suggest rules for it.

    The profile is stored first. It tells which columns may be lists, and only their
    values are looked up.
    """
    stored = write_layer(profile(df, top_k=0), work_path(df.sparkSession, "suggest-profile"))
    few = _few(F.col("distinct_count"), F.col("total_rows"), listed_share, max_listed)
    texts = stored.filter((F.col("data_type") == "string") & few).select("column", "distinct_count").collect()  # of the schema
    if texts:
        ranked = F.array_sort(F.collect_list(F.struct("rank", "value")))
        most = max(row["distinct_count"] for row in texts)
        values = top_values(df, most, columns=[row["column"] for row in texts]).groupBy("column").agg(
            F.transform(ranked, lambda r: r["value"]).alias("top_values")
        )
        stored = stored.drop("top_values").join(values, "column", "left")
    return suggest_from_profile(stored, listed_share=listed_share, max_listed=max_listed)


def rules_from_frame(rules: DataFrame) -> list[Rule]:
    """The rules of one suite, at most a handful per column, for ``run_suite``.

    Rows with a ``problem`` (quarantined answers) are no rules and are refused.
    """
    if "problem" in rules.columns and not rules.filter(F.col("problem").isNotNull()).isEmpty():
        raise ValueError("rows with a problem are no rules; keep good_rules() of them")
    return [
        Rule(
            row["rule_type"],
            row["column"],
            min_value=row["min_value"],
            max_value=row["max_value"],
            accepted=None if row["accepted"] is None else tuple(row["accepted"]),
            max_null_rate=row["max_null_rate"],
            reasoning=row["reasoning"] or "",
        )
        for row in rules.select(*[f.name for f in RULES.fields]).collect()
    ]


def rules_to_json(rules: DataFrame, dataset_name: str) -> DataFrame:
    """The rule set as one JSON document; parameters a rule lacks are left out.

    Rules are in the order of the columns suggested for, or of their numbers.
    """
    order = {"accepted_values": 4, "not_null": 0, "null_rate": 1, "unique": 2, "value_range": 3}
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    given = [c for c in ("position", "rule_no") if c in rules.columns]
    document = F.struct(
        *given,
        F.try_element_at(places, F.col("rule_type")).alias("place"),
        F.struct(
            "column",
            "rule_type",
            F.struct("min_value", "max_value", "accepted", "max_null_rate").alias("parameters"),
            "reasoning",
        ).alias("rule"),
    )
    return (
        rules.groupBy(F.lit(dataset_name).alias("dataset_name"))
        .agg(F.array_sort(F.collect_list(document)).alias("found"))
        .select(
            "dataset_name",
            F.to_json(
                F.struct(
                    "dataset_name",
                    F.transform("found", lambda d: d["rule"]).alias("rules"),
                    F.format_string("%d rules", F.size("found")).alias("summary"),
                )
            ).alias("rules_json"),
        )
    )
