"""Prompt texts for an outside model, and checked parsing of its answers.

No model is called here. Prompts leave as a column, answers come back as a
column, and any service may sit in between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_fences
from .checks import RULE_TYPES

SEVERITIES = ("HIGH", "MEDIUM", "LOW")

_TAIL = "end of answer"


# --- documents and prompts ---


def profile_to_json(profiled: DataFrame) -> DataFrame:
    """One JSON document per profiled column; statistics a column lacks are left out."""
    return profiled.select("position", "column", F.to_json(_profile_struct()).alias("profile_json"))


def _profile_struct() -> Column:
    return F.struct(
        "column",
        "total_rows",
        "null_rate",
        "null_count",
        "distinct_count",
        "min",
        "max",
        "mean",
        "stddev",
        "top_values",
    )


def sample_rows_json(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows as JSON documents, chosen by a hash of the key."""
    picked = df.withColumn("pick", F.md5(F.col(key).cast("string"))).orderBy("pick", key).limit(n)
    body = F.to_json(F.struct(*df.columns))
    return picked.select("pick", body.alias("row_json"))


def rule_prompt(
    profile_docs: DataFrame, dataset_name: str, sample_docs: DataFrame | None = None
) -> DataFrame:
    """One prompt asking for rules, from a profile and, if given, sample rows.

    It holds one line per column and per sampled row.
    """
    head = (
        f"Suggest data quality rules for the dataset {dataset_name}.\n"
        f"Use only these rule types: {', '.join(RULE_TYPES)}.\n"
        "Answer with one JSON object with the fields dataset_name, rules and summary. "
        "Each rule has the fields column, rule_type, parameters and reasoning."
    )
    lines = profile_docs.select(
        F.lit(1).alias("block"),
        F.col("position").cast("long").alias("place"),
        F.lit("").alias("pick"),
        F.col("profile_json").alias("text"),
    )
    if sample_docs is not None:
        lines = lines.unionByName(
            sample_docs.select(
                F.lit(2).alias("block"), F.lit(0).cast("long").alias("place"), "pick", F.col("row_json").alias("text")
            )
        )
    ordered = F.array_sort(F.collect_list(F.struct("block", "place", "pick", "text")))

    def block(number: int) -> Column:
        chosen = F.filter("lines", lambda d: d["block"] == number)
        return F.array_join(F.transform(chosen, lambda d: d["text"]), "\n")

    parts = [F.lit(f"{head}\nPROFILE\n"), block(1)]
    if sample_docs is not None:
        parts += [F.lit("\nSAMPLE ROWS\n"), block(2)]
    return (
        lines.groupBy(F.lit(dataset_name).alias("dataset_name"))
        .agg(ordered.alias("lines"))
        .select("dataset_name", F.concat(*parts).alias("prompt"))
    )


def root_cause_prompt(failures: DataFrame) -> DataFrame:
    """One prompt per failed check, with the statistics of both batches."""

    def snapshot(**fields: str) -> Column:
        return F.to_json(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]))

    prompt = F.concat(
        F.lit("Explain why a data quality check failed.\nCHECK "),
        F.col("check_name"),
        F.lit("\nCOLUMN "),
        F.col("column"),
        F.lit("\nBEFORE "),
        snapshot(metric="previous_level", rows="previous_rows", batch_date="previous_date"),
        F.lit("\nNOW "),
        snapshot(metric="level", rows="total_rows", batch_date="batch_date"),
        F.lit(
            "\nAnswer with one JSON object with the fields failed_check, column, explanation, "
            "confidence (0 to 1), recommended_investigation and severity "
            f"({', '.join(SEVERITIES)})."
        ),
    )
    return failures.select("batch_id", "check_name", "column", prompt.alias("prompt"))


# --- parsing ---


def _strict_json(text: Column) -> Column:
    """The answer as a variant; NULL unless the whole text is one JSON value.

    The parser stops after the first value, so the text is put into an array
    before a closing mark, which must then come right after it.
    """
    framed = F.concat(F.lit("["), text, F.lit(f',"{_TAIL}"]'))
    items = F.try_variant_get(F.try_parse_json(framed), "$", "array<variant>")
    whole = (F.size(items) == 2) & (F.try_variant_get(F.get(items, 1), "$", "string") == _TAIL)
    return F.when(whole, F.get(items, 0))


def _field(value: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _is_text(value: Column, name: str) -> Column:
    kind = F.schema_of_variant(_field(value, name, "variant"))
    return F.coalesce(kind == "STRING", F.lit(False))


def _is_number(value: Column, name: str) -> Column:
    kind = F.schema_of_variant(_field(value, name, "variant"))
    return F.coalesce(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))


def _is_absent(value: Column, name: str) -> Column:
    """Not there, or a JSON null."""
    kind = F.schema_of_variant(_field(value, name, "variant"))
    return kind.isNull() | (kind == "VOID")


def _unfit_parameters(rule: Column) -> Column:
    """Whether a parameter that the rule's type needs is missing or of another type."""
    rule_type = _field(rule, "rule_type", "string")
    low, high = "parameters.min_value", "parameters.max_value"
    bounds = [_is_absent(rule, b) | _is_number(rule, b) for b in (low, high)]
    bounded = bounds[0] & bounds[1] & ~(_is_absent(rule, low) & _is_absent(rule, high))
    listed = _field(rule, "parameters.accepted", "array<variant>")
    plain = F.forall(listed, lambda v: F.schema_of_variant(v).rlike("^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL)"))
    share = _field(rule, "parameters.max_null_rate", "double")
    return ~(
        F.when(rule_type == "value_range", bounded)
        .when(rule_type == "accepted_values", F.coalesce(plain, F.lit(False)))
        .when(
            rule_type == "null_rate",
            _is_number(rule, "parameters.max_null_rate") & F.coalesce(share.between(0, 1), F.lit(False)),
        )
        .otherwise(F.lit(True))
    )


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _has_object(value: Column, name: str) -> Column:
    return _field(value, name, "map<string,variant>").isNotNull()


def _first_problem(problems: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(found, F.lit(text)) for found, text in problems])


def _well_formed_rule(rule: Column) -> Column:
    texts = [_is_text(rule, f) for f in ("column", "rule_type", "reasoning")]
    parts = [_is_object(rule), *texts, _has_object(rule, "parameters")]
    return reduce(lambda a, b: a & b, parts)


def parse_rule_sets(responses: DataFrame, key: str, text: str) -> DataFrame:
    """Answers holding rule sets, as one row per rule.

    ``problem`` is NULL on good rules. An answer that is not JSON, lacks a field
    or has one of the wrong type is refused whole, with ``rule_no`` NULL; a rule
    of a type that does not exist, or whose parameters are missing or of another
    type (bounds and shares are numbers), is refused alone. An accepted answer without
    rules gives one row with both columns NULL.
    """
    answer, rules = F.col("answer"), F.col("rules")
    problems = [
        (answer.isNull(), "not JSON"),
        (~_is_object(answer), "not an object"),
        (~_is_text(answer, "dataset_name"), "dataset_name"),
        (rules.isNull(), "rules"),
        (~F.forall(rules, _well_formed_rule), "rule fields"),
        (~_is_text(answer, "summary"), "summary"),
    ]

    def typed(rule: Column, index: Column) -> Column:
        rule_type = _field(rule, "rule_type", "string")

        def parameter(name: str, kind: str) -> Column:
            return _field(rule, f"parameters.{name}", kind).alias(name)

        return F.struct(
            (index + 1).alias("rule_no"),
            _field(rule, "column", "string").alias("column"),
            rule_type.alias("rule_type"),
            parameter("min_value", "double"),
            parameter("max_value", "double"),
            parameter("accepted", "array<string>"),
            parameter("max_null_rate", "double"),
            _field(rule, "reasoning", "string").alias("reasoning"),
            F.when(~rule_type.isin(*RULE_TYPES), F.lit("rule type"))
            .when(_unfit_parameters(rule), F.lit("parameters"))
            .alias("rule_problem"),
        )

    checked = (
        responses.select(key, _strict_json(strip_fences(F.col(text))).alias("answer"))
        .withColumn("rules", _field(answer, "rules", "array<variant>"))
        .withColumn("answer_problem", _first_problem(problems))
    )
    good = F.when(F.col("answer_problem").isNull(), F.transform(rules, typed))
    return checked.select(
        key,
        _field(answer, "dataset_name", "string").alias("dataset_name"),
        "answer_problem",
        F.inline_outer(good),
    ).select(
        key,
        "dataset_name",
        "rule_no",
        "column",
        "rule_type",
        "min_value",
        "max_value",
        "accepted",
        "max_null_rate",
        "reasoning",
        F.coalesce("answer_problem", "rule_problem").alias("problem"),
    )


def good_rules(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull() & F.col("rule_no").isNotNull())


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull())


def parse_root_causes(responses: DataFrame, key: str, text: str) -> DataFrame:
    """Answers holding root causes, one row each; ``problem`` names what is wrong."""
    answer = F.col("answer")
    texts = ("failed_check", "column", "explanation", "recommended_investigation", "severity")
    confidence, severity = _field(answer, "confidence", "double"), _field(answer, "severity", "string")
    problems = [
        (answer.isNull(), "not JSON"),
        (~_is_object(answer), "not an object"),
        *[(~_is_text(answer, name), name) for name in texts],
        (~_is_number(answer, "confidence") | ~confidence.between(0, 1), "confidence"),
        (~severity.isin(*SEVERITIES), "severity"),
    ]
    checked = responses.select(
        key, _strict_json(strip_fences(F.col(text))).alias("answer")
    ).withColumn("problem", _first_problem(problems))
    good = F.col("problem").isNull()
    return checked.select(
        key,
        *[F.when(good, _field(answer, name, "string")).alias(name) for name in texts],
        F.when(good, confidence).alias("confidence"),
        "problem",
    )
