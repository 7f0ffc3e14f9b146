"""Rule sets as JSON files, one document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.responses import parse_rule_sets
from ..operators.suggest import rules_to_json


def write_rules(rules: DataFrame, dataset_name: str, path: str) -> None:
    rules_to_json(rules, dataset_name).select("rules_json").write.mode("overwrite").text(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of all documents below ``path``, with what is wrong in ``problem``."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    return parse_rule_sets(lines, "file", "value")
