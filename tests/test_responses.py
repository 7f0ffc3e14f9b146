from __future__ import annotations

import json

import pytest

from plumbline import (
    good_rules,
    parse_root_causes,
    parse_rule_sets,
    profile,
    profile_to_json,
    quarantined,
    rule_prompt,
    rules_from_frame,
    sample_rows_json,
)
from plumbline.operators.responses import parse_root_causes, parse_rule_sets
from plumbline.functions.text import severity_marker, strip_space
from pyspark.sql import functions as F

RULE = {"column": "order_amount", "rule_type": "value_range", "parameters": {"min_value": 0, "max_value": 5000}, "reasoning": "positive"}
SET = {"dataset_name": "silver_orders", "rules": [RULE], "summary": "clean"}
CAUSE = {
    "failed_check": "expect_not_null",
    "column": "payment_method",
    "explanation": "Null rate rose",
    "confidence": 0.85,
    "recommended_investigation": "read the logs",
    "severity": "HIGH",
}


def answers(spark, *texts):
    rows = [(i, t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, text string")


def rule_problems(spark, *texts):
    parsed = parse_rule_sets(answers(spark, *texts), "id", "text")
    return [r["problem"] for r in parsed.orderBy("id", "rule_no").collect()]


def cause_problems(spark, *texts):
    return [r["problem"] for r in parse_root_causes(answers(spark, *texts), "id", "text").orderBy("id").collect()]


def without(document, name):
    return {k: v for k, v in document.items() if k != name}


def test_sound_rule_sets(spark):
    ages = {**RULE, "column": "customer_age", "parameters": {"min_value": 18, "max_value": 100}}
    ids = {**RULE, "column": "order_id", "rule_type": "unique", "parameters": {}}
    listed = {**RULE, "column": "c", "rule_type": "accepted_values", "parameters": {"accepted": ["x", "y"]}}
    rated = {**RULE, "rule_type": "null_rate", "parameters": {"max_null_rate": 0.05, "other": [1]}}
    texts = [SET, {**SET, "rules": [ages, ids, listed, rated]}, '{"dataset_name": "test", "rules": [], "summary": "ok"}']
    parsed = parse_rule_sets(answers(spark, *texts), "id", "text").cache()
    assert quarantined(parsed).count() == 0
    good = good_rules(parsed).orderBy("id", "rule_no").collect()
    assert [(r["id"], r["rule_no"], r["rule_type"]) for r in good] == [
        (0, 1, "value_range"), (1, 1, "value_range"), (1, 2, "unique"), (1, 3, "accepted_values"), (1, 4, "null_rate"),
    ]
    assert (good[1]["min_value"], good[1]["max_value"]) == (18.0, 100.0)
    assert good[3]["accepted"] == ["x", "y"] and good[4]["max_null_rate"] == 0.05
    assert parsed.filter("id = 2").collect()[0]["rule_no"] is None
    assert len(rules_from_frame(good_rules(parsed))) == 5


def test_fences_and_space_around_an_answer(spark):
    body = json.dumps(SET)
    texts = [f"```json\n{body}\n```", f" \n\t```{body}``` \r\n", f"  {body}　", json.dumps(SET, indent=2)]
    assert rule_problems(spark, *texts) == [None] * 4


def test_broken_rule_sets_are_refused_whole(spark):
    body = json.dumps(SET)
    cases = {
        "no rules today": "not JSON",
        "": "not JSON",
        body[:-3]: "not JSON",
        body + " and more": "not JSON",
        body + "," + body: "not JSON",
        body + "]": "not JSON",
        "[1, 2]": "not an object",
        '"text"': "not an object",
        json.dumps(without(SET, "summary")): "summary",
        json.dumps({**SET, "summary": 3}): "summary",
        json.dumps(without(SET, "dataset_name")): "dataset_name",
        json.dumps({**SET, "dataset_name": None}): "dataset_name",
        json.dumps({**SET, "rules": "none"}): "rules",
        json.dumps({**SET, "rules": {"a": 1}}): "rules",
        json.dumps(without(SET, "rules")): "rules",
        json.dumps({**SET, "rules": [RULE, 5]}): "rule fields",
        json.dumps({**SET, "rules": [without(RULE, "reasoning")]}): "rule fields",
        json.dumps({**SET, "rules": [{**RULE, "parameters": "none"}]}): "rule fields",
        json.dumps({**SET, "rules": [{**RULE, "column": 7}]}): "rule fields",
    }
    assert rule_problems(spark, *cases) == list(cases.values())
    assert rule_problems(spark, None) == ["not JSON"]


def test_an_unknown_rule_type_is_refused_alone(spark):
    document = {**SET, "rules": [RULE, {**RULE, "rule_type": "regex_match"}]}
    assert rule_problems(spark, document) == [None, "rule type"]


@pytest.mark.parametrize("change", [{}, {"confidence": 0.75, "severity": "MEDIUM"}, {"severity": "LOW"}, {"confidence": 1}])
def test_sound_root_causes(spark, change):
    parsed = parse_root_causes(answers(spark, {**CAUSE, **change}), "id", "text").collect()[0]
    assert parsed["problem"] is None
    assert 0 <= parsed["confidence"] <= 1 and parsed["severity"] in ("HIGH", "MEDIUM", "LOW")


def test_broken_root_causes(spark):
    cases = {
        "nothing": "not JSON",
        json.dumps({**CAUSE, "confidence": 1.7}): "confidence",
        json.dumps({**CAUSE, "confidence": "high"}): "confidence",
        json.dumps(without(CAUSE, "confidence")): "confidence",
        json.dumps({**CAUSE, "severity": "URGENT"}): "severity",
        json.dumps({**CAUSE, "column": 7}): "column",
        json.dumps(without(CAUSE, "explanation")): "explanation",
    }
    assert cause_problems(spark, *cases) == list(cases.values())
    refused = parse_root_causes(answers(spark, *cases), "id", "text").collect()
    assert all(r["column"] is None and r["confidence"] is None for r in refused)


def test_prompt_with_and_without_samples(spark):
    df = spark.createDataFrame([(1, "UPI"), (2, None)], "id int, payment_method string")
    docs = profile_to_json(profile(df))
    plain = rule_prompt(docs, "orders").collect()[0]["prompt"]
    assert "not_null, unique, value_range, accepted_values, null_rate" in plain and "SAMPLE" not in plain
    full = rule_prompt(docs, "orders", sample_rows_json(df, "id", 1)).collect()[0]["prompt"]
    assert full.startswith(plain) and full.count('"payment_method"') == plain.count('"payment_method"') + ('"UPI"' in full.split("SAMPLE ROWS")[1])
    lines = plain.split("PROFILE\n")[1].split("\n")
    assert [json.loads(line)["column"] for line in lines] == ["id", "payment_method"]
    assert json.loads(lines[1])["top_values"] == ["UPI", None]


def test_markers_and_stripping(spark):
    df = spark.createDataFrame([("HIGH",), ("LOW",), ("URGENT",), (None,)], "s string")
    assert [r[0] for r in df.select(severity_marker(F.col("s"))).collect()] == ["🔴", "🟢", "⚪", "⚪"]
    text = " \t\n a b "
    assert spark.createDataFrame([(text,)], "t string").select(strip_space(F.col("t"))).collect()[0][0] == text.strip()


def test_marks_inside_an_answer_stay(spark):
    text = '```json\n{"failed_check":"a","column":"b","explanation":"run ```sql x``` now","confidence":0.5,"recommended_investigation":"c","severity":"LOW"}\n```'
    df = spark.createDataFrame([(1, text)], "k int, t string")
    assert parse_root_causes(df, "k", "t").first().explanation == "run ```sql x``` now"


@pytest.mark.parametrize("confidence", ["true", '"0.5"', "null", "[1]"])
def test_a_confidence_must_be_a_number(spark, confidence):
    text = '{"failed_check":"a","column":"b","explanation":"e","confidence":%s,"recommended_investigation":"c","severity":"LOW"}'
    df = spark.createDataFrame([(1, text % confidence)], "k int, t string")
    assert parse_root_causes(df, "k", "t").first().problem == "confidence"


@pytest.mark.parametrize(
    ("rule_type", "parameters"),
    [
        ("value_range", '{"min_value":"ten"}'), ("value_range", '{"max_value":"2024-01-01"}'), ("value_range", "{}"),
        ("value_range", '{"min_value":null}'), ("null_rate", '{"max_null_rate":"low"}'), ("null_rate", "{}"),
        ("null_rate", '{"max_null_rate":2}'), ("accepted_values", '{"accepted":"a"}'), ("accepted_values", '{"accepted":["a",null]}'),
        ("accepted_values", "{}"),
    ],
)
def test_rules_with_unfit_parameters_are_refused(spark, rule_type, parameters):
    text = '{"dataset_name":"d","summary":"s","rules":[{"column":"c","rule_type":"%s","parameters":%s,"reasoning":"r"}]}'
    df = spark.createDataFrame([(1, text % (rule_type, parameters))], "k int, t string")
    assert parse_rule_sets(df, "k", "t").first().problem == "parameters"
