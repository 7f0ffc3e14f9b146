"""The order shape derived from the table ``orders``, with reproducible faults.

All values follow from the order key, so any engine derives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import Bucket
from ..operators.faults import (
    Fault,
    inject_faults,
    negate,
    null_out,
    repeat_key,
    replace_with,
    shift_years,
)
from ..schemas import CATEGORIES, DELIVERY_STATUSES, PAYMENT_METHODS, TRACKED_ORDERS

# The orders end in August 2001; "today" is the end of that year.
AS_OF = dt.date(2001, 12, 31)
# Batch 0 arrived on this day, batch 4 on AS_OF.
FIRST_BATCH_DAY = dt.date(2001, 12, 27)
BATCHES = 5
RUN_OF_KEYS = 50  # keys of one run arrive in the same batch

REPEATED_ID = repeat_key("order_id", Bucket(1, 50, start=49, width=1))
NEGATIVE_AMOUNT = negate("order_amount", Bucket(31, 20, start=3, width=1))
LATE_DATE = shift_years("order_date", Bucket(37, 100, start=0, width=3), years=40)
UNKNOWN_CATEGORY = replace_with("product_category", Bucket(41, 100, start=0, width=7), ["Unknown"])
MISSING_PAYMENT = null_out("payment_method", Bucket(43, 100, start=0, width=15))
FAULTS = (REPEATED_ID, NEGATIVE_AMOUNT, LATE_DATE, UNKNOWN_CATEGORY, MISSING_PAYMENT)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the declared shape, without faults."""
    key = F.col("o_orderkey")

    def pick(values: tuple[str, ...]):
        return F.element_at(
            F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int")
        )

    delivered, pending, cancelled = DELIVERY_STATUSES
    status = F.col("o_orderstatus")
    columns = {
        "src_key": key,
        "order_id": key,
        "customer_id": F.col("o_custkey"),
        "order_amount": F.col("o_totalprice"),
        "order_date": F.to_date("o_orderdate"),
        "product_category": pick(CATEGORIES),
        "payment_method": pick(PAYMENT_METHODS),
        "delivery_status": F.when(status == "F", delivered)
        .when(status == "P", pending)
        .when(status == "O", cancelled),
        "customer_age": F.lit(18) + F.pmod(F.col("o_custkey"), F.lit(62)),
        "batch_id": F.pmod(F.expr(f"o_orderkey div {RUN_OF_KEYS}"), F.lit(BATCHES)),
    }
    return read_table(spark, sf_dir, "orders").select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in TRACKED_ORDERS.fields]
    )


def dirty_orders(spark: SparkSession, sf_dir: str, faults: tuple[Fault, ...] = FAULTS) -> DataFrame:
    """Orders with five kinds of faults, at the same rates in every batch."""
    return inject_faults(clean_orders(spark, sf_dir), "src_key", faults)


def drifting_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders whose payment methods go missing in batch 3: 34 % against 1 %."""
    base = dirty_orders(spark, sf_dir, FAULTS[:-1])
    usual, bad = Bucket(43, 100, start=0, width=1), Bucket(43, 100, start=0, width=34)
    key = F.col("src_key")
    missing = F.when(F.col("batch_id") == 3, bad.holds(key)).otherwise(usual.holds(key))
    return base.withColumn("payment_method", F.when(~missing, F.col("payment_method")))


# Answers of an outside model, one per order, sound and broken ones. The text
# is an SQL expression that any engine evaluates alike.
RULE_SET_ANSWER = """
CASE o_orderkey % 16
 WHEN 0 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_amount","rule_type":"value_range","parameters":{"min_value":', CAST(o_custkey AS VARCHAR(20)), ',"max_value":5000.5},"reasoning":"positive"}],"summary":"one"}')
 WHEN 1 THEN concat('```json', chr(10), '{"dataset_name":"orders","rules":[{"column":"order_id","rule_type":"unique","parameters":{},"reasoning":"key ', CAST(o_orderkey AS VARCHAR(20)), '"}],"summary":"fenced"}', chr(10), '```')
 WHEN 2 THEN concat(' ', chr(10), '```', chr(10), '{"dataset_name":"orders","rules":[{"column":"payment_method","rule_type":"null_rate","parameters":{"max_null_rate":0.05},"reasoning":"gaps"},{"column":"customer_id","rule_type":"not_null","parameters":{},"reasoning":"', CAST(o_custkey AS VARCHAR(20)), '"}],"summary":"two"}```', chr(10), ' ')
 WHEN 3 THEN concat('Sorry, no rules for order ', CAST(o_orderkey AS VARCHAR(20)))
 WHEN 4 THEN concat('{"dataset_name":"orders ', CAST(o_orderkey AS VARCHAR(20)), '","rules":[]}')
 WHEN 5 THEN concat('{"dataset_name":"orders","rules":"none","summary":"', CAST(o_custkey AS VARCHAR(20)), '"}')
 WHEN 6 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_id","rule_type":"not_null","parameters":{},"reasoning":"key"},{"column":"order_id","rule_type":"regex_match","parameters":{},"reasoning":"', CAST(o_custkey AS VARCHAR(20)), '"}],"summary":"one of two"}')
 WHEN 7 THEN concat('{"dataset_name":"orders","rules":[{"column":"product_category","rule_type":"accepted_values","parameters":{"accepted":["Books","c', CAST(o_custkey AS VARCHAR(20)), '"]},"reasoning":"list"}],"summary":"list"}')
 WHEN 8 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_id","rule_ty', CAST(o_custkey AS VARCHAR(20)))
 WHEN 9 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_amount","rule_type":"value_range","parameters":{"min_value":"ten","max_value":', CAST(o_custkey AS VARCHAR(20)), '},"reasoning":"text bound"}],"summary":"bound"}')
 WHEN 10 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_date","rule_type":"value_range","parameters":{"max_value":"2001-12-31"},"reasoning":"date bound ', CAST(o_custkey AS VARCHAR(20)), '"}],"summary":"date"}')
 WHEN 11 THEN concat('{"dataset_name":"orders","rules":[{"column":"payment_method","rule_type":"null_rate","parameters":{"max_null_rate":"low"},"reasoning":"', CAST(o_custkey AS VARCHAR(20)), '"},{"column":"payment_method","rule_type":"null_rate","parameters":{},"reasoning":"none given"}],"summary":"shares"}')
 WHEN 12 THEN concat('{"dataset_name":"orders","rules":[{"column":"product_category","rule_type":"accepted_values","parameters":{"accepted":"c', CAST(o_custkey AS VARCHAR(20)), '"},"reasoning":"no list"}],"summary":"list"}')
 WHEN 13 THEN concat('{"dataset_name":"orders","rules":[{"column":"order_amount","rule_type":"value_range","parameters":{"min_value":null},"reasoning":"no bound ', CAST(o_custkey AS VARCHAR(20)), '"}],"summary":"bound"}')
 WHEN 14 THEN concat('{"dataset_name":"orders","rules":[{"column":"customer_id","rule_type":"not_null","parameters":{},"reasoning":"run ```sql select ', CAST(o_custkey AS VARCHAR(20)), '``` now"}],"summary":"marks inside"}')
 ELSE concat('{"dataset_name":"orders","rules":[],"summary":"', CAST(o_custkey AS VARCHAR(20)), '"}')
END
"""

ROOT_CAUSE_ANSWER = """
CASE o_orderkey % 11
 WHEN 0 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"order ', CAST(o_orderkey AS VARCHAR(20)), '","confidence":0.85,"recommended_investigation":"read the logs","severity":"HIGH"}')
 WHEN 1 THEN concat('```json', chr(10), '{"failed_check":"expect_unique","column":"order_id","explanation":"customer ', CAST(o_custkey AS VARCHAR(20)), '","confidence":1,"recommended_investigation":"look for replays","severity":"MEDIUM"}', chr(10), '```')
 WHEN 2 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":1.7,"recommended_investigation":"x","severity":"LOW"}')
 WHEN 3 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":0.5,"recommended_investigation":"x","severity":"URGENT"}')
 WHEN 4 THEN concat('{"failed_check":"expect_not_null","column":7,"explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":0.5,"recommended_investigation":"x","severity":"LOW"}')
 WHEN 5 THEN concat('the cause of ', CAST(o_orderkey AS VARCHAR(20)), ' is unknown')
 WHEN 6 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","recommended_investigation":"x","severity":"LOW"}')
 WHEN 7 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":true,"recommended_investigation":"x","severity":"LOW"}')
 WHEN 8 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":"0.5","recommended_investigation":"x","severity":"LOW"}')
 WHEN 9 THEN concat('{"failed_check":"expect_not_null","column":"payment_method","explanation":"```sql select ', CAST(o_orderkey AS VARCHAR(20)), '```","confidence":0.5,"recommended_investigation":"x","severity":"LOW"}')
 ELSE concat('{"failed_check":"expect_value_range","column":"order_amount","explanation":"', CAST(o_orderkey AS VARCHAR(20)), '","confidence":0.25,"recommended_investigation":"ask sales","severity":"LOW"} ')
END
"""


NUMBER_RULES = """```json
{"dataset_name": "lineitem", "summary": "rules on numbers", "rules": [
 {"column": "l_linenumber", "rule_type": "accepted_values", "parameters": {"accepted": ["1", "2", "3"]}, "reasoning": "texts"},
 {"column": "l_tax", "rule_type": "accepted_values", "parameters": {"accepted": [0, 0.02, "0.04"]}, "reasoning": "mixed"},
 {"column": "l_quantity", "rule_type": "accepted_values", "parameters": {"accepted": ["1", "many"]}, "reasoning": "no number"},
 {"column": "l_quantity", "rule_type": "value_range", "parameters": {"min_value": "one"}, "reasoning": "refused"},
 {"column": "l_quantity", "rule_type": "value_range", "parameters": {"min_value": 1, "max_value": 45.5}, "reasoning": "bounds"},
 {"column": "l_returnflag", "rule_type": "accepted_values", "parameters": {"accepted": ["A", "R"]}, "reasoning": "flags"}]}
```"""


def answers(spark: SparkSession, sf_dir: str, expression: str) -> DataFrame:
    """One model answer per order: ``answer_id, response``."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("answer_id"), F.expr(expression).alias("response")
    )
