"""Every operator as a query over the test tables: ``query(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.buckets import Bucket
from .functions.numeric import round_to
from .functions.text import severity_marker, status_colour
from .operators import checks, drift, monitor, responses
from .operators.dedup import keep_first, upsert_by_key
from .operators.faults import (
    fault_rates,
    inject_faults,
    move_to_future,
    negate,
    null_out,
    repeat_key,
    replace_with,
    seeded_sample,
)
from .operators.lattice import failing_combinations
from .operators.gold import daily_orders, revenue_by_category
from .operators.profile import column_statistics, distinct_counts, profile, top_values
from .operators.sampling import exact_sample
from .operators.schema_history import read_schema_snapshots, schema_changes, write_schema_snapshot
from .operators.silver import (
    accepted,
    deduplicate_orders,
    judge_orders,
    reject_rate,
    reject_reasons,
    rejected,
    to_silver,
    write_verdicts,
)
from .operators.snapshots import merge_snapshots, profile_of_snapshot, sketch_error, snapshot, snapshot_drift
from .operators.responses import good_rules, parse_rule_sets
from .operators.suggest import rules_from_frame, rules_to_json, suggest_rules
from .plans.medallion import run_medallion
from .plans.quality_loop import check_suggested_rules
from .schemas import INVALID_CATEGORIES, ORDERS, TRACKED_ORDERS, TRANSFORMED_AT
from .session import work_path
from .sources.bridge import (
    AS_OF,
    BATCHES,
    FIRST_BATCH_DAY,
    NUMBER_RULES,
    ROOT_CAUSE_ANSWER,
    RULE_SET_ANSWER,
    answers,
    clean_orders,
    dirty_orders,
    drifting_orders,
    read_table,
)
from .sources.history import read_history, write_history
from .sources.layers import read_orders_csv, stamp, write_csv, write_layer
from .streaming import epochs as ep
from .streaming import micro_batches as mb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DATASET = "orders"
SAMPLES = 20
DIMENSIONS = ("product_category", "delivery_status", "batch_id")
CATEGORY_RATES = [("Electronics", 18), ("Clothing", 5), ("Books", None)]
ORDER_COLUMNS = [f.name for f in ORDERS.fields]


def query(name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, under its function name unless another one is given."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        return function

    return register


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(dirty_orders(spark, sf_dir), as_of=AS_OF).drop(TRANSFORMED_AT)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_layer(_silver(spark, sf_dir), work_path(spark, "silver"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_orders(spark, sf_dir).select(*ORDER_COLUMNS)


def _joined(values: str) -> Column:
    """An array as text, NULL elements spelled out."""
    return F.array_join(F.transform(values, lambda v: F.coalesce(v, F.lit("<null>"))), "|")


# --- sources, sinks, layers ---


@query()
def csv_bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw-csv")
    write_csv(_orders(spark, sf_dir), path)
    return read_orders_csv(spark, path, enforce_header=True)


@query()
def bronze_roundtrip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = write_layer(stamp(dirty_orders(spark, sf_dir)), work_path(spark, "bronze"))
    return bronze.agg(F.count("*").alias("bronze_rows"))


@query()
def bronze_audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = write_layer(stamp(dirty_orders(spark, sf_dir)), work_path(spark, "bronze"))
    first, last = F.min("ingested_at"), F.max("ingested_at")
    return bronze.agg(
        F.count("*").alias("bronze_rows"),
        F.count("ingested_at").alias("stamped_rows"),
        (first == last).alias("one_stamp"),
    )


# --- silver and gold ---


@query()
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_orders(dirty_orders(spark, sf_dir))


@query()
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@query()
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deduplicated orders as stored by verdict, the rejected ones with their reasons."""
    judged = judge_orders(deduplicate_orders(dirty_orders(spark, sf_dir)), as_of=AS_OF)
    stored = write_verdicts(judged, work_path(spark, "verdicts")).drop(TRANSFORMED_AT)
    kept = accepted(stored).withColumn("reasons", F.lit(""))
    return kept.unionByName(rejected(stored).withColumn("reasons", F.array_join("reasons", "|")))


@query()
def silver_reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_rate(dirty_orders(spark, sf_dir), _silver(spark, sf_dir))


@query()
def silver_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_reasons(dirty_orders(spark, sf_dir), as_of=AS_OF)


@query()
def gold_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by_category(_silver(spark, sf_dir))


@query()
def gold_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_orders(_silver(spark, sf_dir))


@query()
def gold_charge_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of amounts below a cent: what each line item is charged."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("product_category"),
        charge.alias("order_amount"),
    )
    gold = revenue_by_category(lines)
    return gold.withColumns(
        {c: round_to(F.col(c), 2) for c in ("total_revenue", "avg_order_value")}
    )


@query()
def parsed_rules_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as parsed from an answer, lists as texts, run on columns of numbers and texts."""
    answer = spark.range(1).select(
        F.lit(0).alias("answer_id"), F.lit(NUMBER_RULES).alias("response")
    )
    rules = rules_from_frame(good_rules(parse_rule_sets(answer, "answer_id", "response")).orderBy("rule_no"))
    return checks.run_suite(read_table(spark, sf_dir, "lineitem"), rules, dataset_name="lineitem").select(
        "rule_no", "check_name", "column", "success", "metric_value", "threshold", "message"
    )


@query()
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and revenue of all layers of one stored run."""
    raw = dirty_orders(spark, sf_dir)
    layers = run_medallion(raw, work_path(spark, "medallion"), as_of=AS_OF)

    def rows(layer: str, revenue: str | None = None) -> DataFrame:
        total = F.lit(None)
        if revenue:
            total = F.sum(F.col(revenue).cast("decimal(38,2)"))
        return getattr(layers, layer).agg(
            F.lit(layer).alias("layer"),
            F.count("*").alias("rows"),
            total.cast("double").alias("revenue"),
        )

    gold = rows("revenue_by_category", "total_revenue").unionByName(rows("daily_orders", "daily_revenue"))
    return rows("bronze").unionByName(rows("silver")).unionByName(gold).unionByName(rows("profile"))


@query("upsert_by_key")
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders come again with another amount, some of them out of date."""
    target = clean_orders(spark, sf_dir)
    updates = target.filter(F.col("delivery_status") == "Pending").withColumns(
        {
            "order_amount": F.col("order_amount") + 1000,
            "order_date": F.date_add("order_date", F.col("customer_age") % 7 - 3),
        }
    )
    newest_first = [F.desc("order_date")]
    return upsert_by_key(target, updates, ["order_id"], newest_first).select(
        "order_id", "order_date", F.col("order_amount").cast("decimal(18,2)").cast("double").alias("order_amount")
    )


# --- profile ---

PROFILE_COLUMNS = (
    "column",
    "total_rows",
    "null_count",
    "null_rate",
    "distinct_count",
    "min",
    "max",
    "mean",
    "stddev",
    "first_day",
    "last_day",
)


@query()
def profile_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _stored_silver(spark, sf_dir).select(*ORDER_COLUMNS)
    return profile(silver).select(*PROFILE_COLUMNS, _joined("top_values").alias("top_values"))


@query()
def profile_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(_orders(spark, sf_dir)).select(
        *PROFILE_COLUMNS, _joined("top_values").alias("top_values")
    )


def _profile_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return profile(read_table(spark, sf_dir, name)).select(
        *PROFILE_COLUMNS, _joined("top_values").alias("top_values")
    )


@query()
def profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_table(spark, sf_dir, "lineitem")


@query()
def profile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, exact copies among them."""
    return _profile_table(spark, sf_dir, "documents")


@query()
def profile_distinct_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched distinct counts from one pass without a shuffle of values."""
    approx = profile(_orders(spark, sf_dir), top_k=0, approx_distinct=True)
    return approx.select("column", "total_rows", "null_count", "distinct_count")


@query()
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = column_statistics(read_table(spark, sf_dir, "lineitem"))
    return stats.filter(F.col("lowest").isNotNull()).select(
        "column", "total_rows", "null_count", "min", "max", "mean", "stddev"
    )


@query()
def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(_orders(spark, sf_dir), 5)


def _snapshots(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Snapshots of the batches, each stored once."""
    return write_layer(snapshot(df, "batch_id"), work_path(spark, "snapshots"), mode="append")


@query()
def profile_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the silver layer from what its batches added, without reading it."""
    silver = _stored_silver(spark, sf_dir).select(*ORDER_COLUMNS, "batch_id")
    merged = merge_snapshots(_snapshots(spark, silver))
    return profile_of_snapshot(merged).select(*[c for c in PROFILE_COLUMNS if c != "distinct_count"])


@query()
def distinct_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the merged sketches are within their stated error of the exact counts."""
    raw = write_layer(dirty_orders(spark, sf_dir).select(*ORDER_COLUMNS, "batch_id"), work_path(spark, "raw"))
    merged = profile_of_snapshot(merge_snapshots(_snapshots(spark, raw))).withColumnRenamed("distinct_count", "sketched")
    exact = distinct_counts(raw.drop("batch_id"))
    off = F.abs(F.col("sketched") - F.col("distinct_count")) / F.col("distinct_count")
    return merged.join(F.broadcast(exact), "column").select(  # one row per column
        "column", "distinct_count", (off <= sketch_error()).alias("within_error")
    )


@query()
def drift_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of every batch beside the batch before, from snapshots only."""
    return snapshot_drift(_snapshots(spark, drifting_orders(spark, sf_dir).select(*ORDER_COLUMNS, "batch_id")), "batch_id")


# --- checks ---


def _check(spark: SparkSession, sf_dir: str, rules: Iterable[checks.Rule]) -> DataFrame:
    return checks.run_suite(dirty_orders(spark, sf_dir), list(rules), dataset_name=DATASET).drop(
        "checked_at"
    )


@query()
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, [checks.not_null("order_id"), checks.not_null("payment_method")])


@query()
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(
        spark, sf_dir, [checks.unique("order_id"), checks.unique("src_key"), checks.unique("payment_method")]
    )


@query()
def check_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(
        spark,
        sf_dir,
        [
            checks.value_range("order_amount", min_value=0),
            checks.value_range("order_amount", max_value=400000),
            checks.value_range("customer_age", 18, 100),
            checks.value_range("order_date", max_value=AS_OF),
            checks.value_range("customer_age"),
        ],
    )


@query()
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(
        spark,
        sf_dir,
        [
            checks.accepted_values("product_category", ["Electronics", "Clothing", "Books", "Food"]),
            checks.accepted_values("payment_method", ["UPI", "Card", "COD"]),
            checks.accepted_values("delivery_status", []),
        ],
    )


@query()
def check_null_rate_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(
        spark,
        sf_dir,
        [
            checks.null_rate_below("payment_method", 0.05),
            checks.null_rate_below("payment_method", 0.15),
            checks.null_rate_below("order_id", 0.0),
        ],
    )


@query()
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, checks.order_suite())


@query()
def check_suite_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _stored_silver(spark, sf_dir)
    return checks.run_suite(silver, checks.order_suite(), dataset_name="silver_orders").drop("checked_at")


@query()
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.summarise(_check(spark, sf_dir, checks.order_suite()))


@query()
def check_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.describe(_check(spark, sf_dir, checks.order_suite()))


@query()
def check_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that cannot run are reported, the others run."""
    rules = [
        checks.Rule("regex_match", "order_id"),
        checks.not_null("coupon"),
        checks.null_rate_below("payment_method", 0.2),
    ]
    return _check(spark, sf_dir, rules)


def _batch_results(df: DataFrame) -> DataFrame:
    return checks.run_suite(df, checks.order_suite(), dataset_name=DATASET, by=["batch_id"])


@query()
def check_suite_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_results(dirty_orders(spark, sf_dir)).drop("checked_at")


@query()
def check_result_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every result carries the time of its run, one for all of them."""
    results = _batch_results(dirty_orders(spark, sf_dir))
    newest = results.agg(F.max("checked_at").alias("newest"))  # one row
    first, last = F.min("checked_at"), F.max("checked_at")
    timed = results.groupBy("batch_id", "dataset_name").agg(
        F.count("*").alias("results"),
        F.count("checked_at").alias("timed_results"),
        (first == last).alias("one_time"),
        last.alias("at"),
    )
    return timed.join(F.broadcast(newest), F.col("at") == F.col("newest")).drop("at", "newest")


@query()
def literal_rates_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows given in the program as a table, joined with the orders they describe."""
    rates = spark.createDataFrame(CATEGORY_RATES, "product_category string, percent int")
    amounts = clean_orders(spark, sf_dir).join(F.broadcast(rates), "product_category", "left")  # a row per category
    cents = F.col("order_amount").cast("decimal(18,2)") * F.coalesce("percent", F.lit(0))
    return amounts.groupBy("product_category").agg(
        F.count("*").alias("orders"), F.max("percent").alias("percent"), F.sum(cents).cast("double").alias("percents_due")
    )


@query()
def check_events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rules = [
        checks.not_null("user_id"),
        checks.unique("event_id"),
        checks.unique("user_id"),
        checks.value_range("value", 0, 50),
        checks.accepted_values("event_type", ["click", "view", "purchase"]),
    ]
    return checks.run_suite(events, rules, dataset_name="events", by=["day"]).drop("checked_at")


@query()
def check_schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a renamed, a retyped, an unreadable and two further columns."""
    sent = dirty_orders(spark, sf_dir).withColumnRenamed("delivery_status", "status").withColumns(
        {
            "customer_age": F.col("customer_age").cast("bigint"),
            "order_amount": F.when(F.pmod("src_key", F.lit(11)) == 0, "n/a").otherwise(
                F.col("order_amount").cast("decimal(18,2)").cast("string")
            ),
        }
    )
    return checks.check_schema(sent, ORDERS)


@query()
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in which a column appears, vanishes, comes back, moves and changes its type."""
    root, orders = work_path(spark, "schema-drift"), _orders_by_batch(spark, sf_dir)
    amount = F.col("order_amount").cast("decimal(18,2)").cast("string")
    sent = [
        orders[0],
        orders[1].withColumn("coupon", F.lit("none")),
        orders[2].withColumn("coupon", F.lit("none")),
        orders[3].drop("delivery_status").withColumns({"order_amount": amount, "customer_age": F.col("customer_age").cast("bigint")}),
        orders[4].select("customer_id", *[c for c in ORDER_COLUMNS if c != "customer_id"]),
    ]
    for batch, df in enumerate(sent):
        write_schema_snapshot(write_layer(df, f"{root}/sent-{batch}"), batch, f"{root}/schemas")
    return schema_changes(read_schema_snapshots(spark, f"{root}/schemas"))


def _orders_by_batch(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    dirty = dirty_orders(spark, sf_dir)
    return [dirty.filter(F.col("batch_id") == b).select(*ORDER_COLUMNS) for b in range(BATCHES)]


# --- faults ---


@query("inject_faults")
def inject_all_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    faults = [
        null_out("payment_method", Bucket(43, 100, start=0, width=15)),
        negate("order_amount", Bucket(31, 20, start=3, width=1)),
        move_to_future("order_date", Bucket(37, 100, start=0, width=3), AS_OF),
        replace_with("product_category", Bucket(41, 100, start=0, width=7), INVALID_CATEGORIES),
        repeat_key("order_id", Bucket(1, 50, start=49, width=1)),
    ]
    return inject_faults(clean_orders(spark, sf_dir), "src_key", faults)


@query("fault_rates")
def measured_fault_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fault_rates(dirty_orders(spark, sf_dir), AS_OF)


@query("seeded_sample")
def sampled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_sample(clean_orders(spark, sf_dir), "src_key", percent=15, seed=42)


@query("exact_sample")
def exactly_sampled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sample(clean_orders(spark, sf_dir), "src_key", percent=12.5, seed=42)


# --- rule suggestion, prompts, answers ---


@query("suggest_rules")
def suggested_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggest_rules(_orders(spark, sf_dir)).withColumn(
        "accepted", F.array_join("accepted", "|")
    )


@query("rules_to_json")
def suggested_rules_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_to_json(suggest_rules(_orders(spark, sf_dir)), DATASET)


@query()
def suggested_rules_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules suggested from clean orders, run on dirty ones."""
    clean = clean_orders(spark, sf_dir).select(*ORDER_COLUMNS)
    return check_suggested_rules(clean, _orders(spark, sf_dir), dataset_name=DATASET).drop("checked_at")


@query("profile_to_json")
def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.profile_to_json(profile(_orders(spark, sf_dir)))


@query("sample_rows_json")
def sample_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.sample_rows_json(dirty_orders(spark, sf_dir), "src_key", SAMPLES)


@query("rule_prompt")
def rule_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled, samples = profile_documents(spark, sf_dir), sample_documents(spark, sf_dir)
    return responses.rule_prompt(profiled, DATASET, samples)


@query("parse_ruleset_json")
def parsed_rule_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = responses.parse_rule_sets(
        answers(spark, sf_dir, RULE_SET_ANSWER), "answer_id", "response"
    )
    return parsed.withColumn("accepted", F.array_join("accepted", "|"))


@query("parse_root_cause_json")
def parsed_root_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.parse_root_causes(
        answers(spark, sf_dir, ROOT_CAUSE_ANSWER), "answer_id", "response"
    )


def _text_answers(documents: DataFrame, answer: Column) -> DataFrame:
    """Answers that carry whole texts: sound, fenced, with words around them, and broken off half way."""
    kind = F.pmod("doc_id", F.lit(4))
    response = (
        F.when(kind == 0, answer)
        .when(kind == 1, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("Here it is: "), answer))
        .otherwise(F.expr("left(answer, length(answer) div 2)"))
    )
    return documents.withColumn("answer", answer).select("doc_id", response.alias("response"))


@query()
def parse_rules_over_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule sets written by a JSON writer around whole documents, read back."""
    documents = read_table(spark, sf_dir, "documents")
    listed = F.struct(F.array("lang", "text").alias("accepted"))
    rules = F.array(
        F.struct(F.lit("text").alias("column"), F.lit("accepted_values").alias("rule_type"), listed.alias("parameters"), F.col("text").alias("reasoning"))
    )
    answer = F.to_json(F.struct(F.col("source").alias("dataset_name"), rules.alias("rules"), F.col("text").alias("summary")))
    parsed = responses.parse_rule_sets(_text_answers(documents, answer), "doc_id", "response")
    return parsed.select(
        "doc_id",
        "dataset_name",
        "rule_no",
        F.sha2("reasoning", 256).alias("reasoning_sha256"),
        F.sha2(F.get("accepted", 1), 256).alias("accepted_sha256"),
        "problem",
    )


@query()
def parse_causes_over_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root causes written by a JSON writer around whole documents, read back."""
    documents = read_table(spark, sf_dir, "documents")
    severity = F.element_at(F.array(*map(F.lit, ("HIGH", "MEDIUM", "LOW", "URGENT"))), (F.pmod(F.expr("doc_id div 4"), F.lit(4)) + 1).cast("int"))
    answer = F.to_json(
        F.struct(
            F.lit("expect_not_null").alias("failed_check"),
            F.col("lang").alias("column"),
            F.col("text").alias("explanation"),
            (F.pmod("n_chars", F.lit(125)) / 100).alias("confidence"),
            F.col("source").alias("recommended_investigation"),
            severity.alias("severity"),
        )
    )
    parsed = responses.parse_root_causes(_text_answers(documents, answer), "doc_id", "response")
    return parsed.select("doc_id", "column", F.sha2("explanation", 256).alias("explanation_sha256"), "confidence", "severity", "problem")


# --- drift and root cause ---


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.batch_drift(_batch_results(drifting_orders(spark, sf_dir)), first_day=FIRST_BATCH_DAY)


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.failure_severity(_drift(spark, sf_dir))


DRIFT_COLUMNS = (
    "batch_id",
    "rule_no",
    "check_name",
    "column",
    "batch_date",
    "total_rows",
    "previous_rows",
    "level",
    "previous_level",
    "change",
)


@query("batch_drift")
def drift_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift(spark, sf_dir).select(*DRIFT_COLUMNS)


@query("failure_severity")
def graded_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir).select(
        "batch_id", "rule_no", "check_name", "column", "level", "change", "severity",
        severity_marker(F.col("severity")).alias("marker"),
    )


@query()
def failure_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = checks.not_null("payment_method")
    return drift.attribute_failures(drifting_orders(spark, sf_dir), rule, DIMENSIONS, k=10)


@query()
def failure_segments_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.failing_segments(
        drifting_orders(spark, sf_dir), checks.order_suite(), DIMENSIONS[:2], by=["batch_id"]
    )


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drifting_orders(spark, sf_dir).withColumn("order_year", F.year("order_date"))


LATTICE_DIMENSIONS = ("product_category", "delivery_status", "order_year", "payment_method")


@query()
def failure_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of up to four dimensions in which at least eight rows fail, per batch."""
    rules = [checks.unique("order_id"), checks.value_range("order_amount", min_value=0), checks.not_null("payment_method")]
    return failing_combinations(
        _dated(spark, sf_dir), rules, LATTICE_DIMENSIONS, by=["batch_id"], min_failing=8
    )


@query()
def failure_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of values with a failing row, whatever the batch."""
    found = failing_combinations(
        _dated(spark, sf_dir), checks.order_suite()[3:6], LATTICE_DIMENSIONS[:3], max_dimensions=2
    )
    return found.filter("dimensions = 2")


@query("root_cause_report")
def root_cause_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = failure_segments_by_batch(spark, sf_dir)
    return drift.root_cause_report(_failures(spark, sf_dir), segments)


@query("root_cause_prompt")
def root_cause_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.root_cause_prompt(_failures(spark, sf_dir))


# --- history ---


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _batch_results(dirty_orders(spark, sf_dir))
    return monitor.to_history(results, first_day=FIRST_BATCH_DAY)


def _plain_time(history: DataFrame) -> DataFrame:
    return history.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query()
def monitor_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.kpis(_history(spark, sf_dir))


@query()
def monitor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = monitor.listing(_history(spark, sf_dir))
    return _plain_time(listed).withColumn("colour", status_colour(F.col("status")))


@query()
def monitor_pass_rate_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.pass_rate_trend(_history(spark, sf_dir), AS_OF)


@query()
def monitor_top_failing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.top_failing_columns(_history(spark, sf_dir))


@query()
def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(monitor.failed(_history(spark, sf_dir)))


@query()
def failed_check_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.failure_labels(_history(spark, sf_dir))


@query()
def history_rechecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored history of two datasets after the last batch of one was checked again on other data."""
    path = work_path(spark, "history")
    write_history(_history(spark, sf_dir), path)
    clean = checks.run_suite(
        clean_orders(spark, sf_dir), checks.order_suite(), dataset_name="clean_orders", by=["batch_id"]
    )
    write_history(monitor.to_history(clean, first_day=FIRST_BATCH_DAY), path)
    again = drifting_orders(spark, sf_dir).filter(F.col("batch_id") == BATCHES - 1)
    write_history(monitor.to_history(_batch_results(again), first_day=FIRST_BATCH_DAY), path)
    return read_history(spark, path).groupBy("dataset_name", "batch").agg(
        F.count("*").alias("checks"), F.count_if(F.col("status") == monitor.PASS).alias("passed_checks")
    )


# --- streaming ---


def _arrive(spark: SparkSession, df: DataFrame, landing: str, batches: Iterable[int]) -> DataFrame:
    """Land batches and return the stream over the landing folder."""
    mb.land(df.filter(F.col("batch_id").isin(*batches)), landing)
    return mb.read_arrivals(spark, landing, TRACKED_ORDERS)


def _checked_stream(spark: SparkSession, df: DataFrame) -> str:
    root = work_path(spark, "stream-checks")
    for batch in range(BATCHES):
        stream = _arrive(spark, df, f"{root}/landing", [batch])
        mb.stream_checks(stream, checks.order_suite(), root, dataset_name=DATASET, by=["batch_id"])
    return root


def _landed(spark: SparkSession, df: DataFrame, root: str) -> ep.Landing:
    """All batches landed one after another, each in so many files as a micro-batch takes."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    landing = ep.Landing(f"{root}/landing", TRACKED_ORDERS, files_per_batch=files)
    for batch in range(BATCHES):
        mb.land(df.filter(F.col("batch_id") == batch).repartition(files), landing.path)
    return landing


def _keep(rules: Iterable[checks.Rule] = (), profiled: bool = False) -> ep.Keep:
    return ep.Keep(
        tuple(rules), as_of=AS_OF, dataset_name=DATASET, batch="batch_id", first_day=FIRST_BATCH_DAY, profiled=profiled
    )


def _layered_stream(spark: SparkSession, df: DataFrame, **kept) -> str:
    """One run over five micro-batches."""
    root = work_path(spark, "stream-layers")
    ep.run_available(spark, _landed(spark, df, root), root, _keep(**kept))
    return root


def _straddling(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.pmod("src_key", F.lit(50)) == 49, F.pmod(F.col("batch_id") + 2, F.lit(BATCHES)))
    return dirty_orders(spark, sf_dir).withColumn("batch_id", F.coalesce(moved, "batch_id"))


@query()
def stream_check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _checked_stream(spark, dirty_orders(spark, sf_dir))
    return mb.read_epochs(spark, root, "results").drop("checked_at")


@query("stream_medallion")
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, dirty_orders(spark, sf_dir))
    return ep.stored_silver(spark, root).drop(mb.EPOCH)


@query()
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, dirty_orders(spark, sf_dir))
    return ep.stored_revenue_by_category(spark, root)


@query()
def stream_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, dirty_orders(spark, sf_dir))
    return ep.stored_daily_orders(spark, root)


@query()
def stream_dedup_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids whose copies arrive in different batches: the first batch wins."""
    root = _layered_stream(spark, _straddling(spark, sf_dir))
    return ep.stored_silver(spark, root)


@query()
def stream_whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one run keeps per epoch: rows of the layers, revenue, checks of the history, alerts."""
    root = _layered_stream(spark, drifting_orders(spark, sf_dir), rules=checks.order_suite())
    gold = ep.committed(spark, root, "gold").groupBy(mb.EPOCH).agg(
        (F.sum("cents").cast("decimal(38,0)").cast("double") / 100).alias("revenue")
    )
    history = ep.committed(spark, root, "history").groupBy(mb.EPOCH).agg(
        F.count_if(F.col("status") == monitor.PASS).alias("passed_checks"),
        F.count_if(F.col("status") == monitor.FAIL).alias("failed_checks"),
    )
    alerts = ep.committed(spark, root, "alerts").groupBy(mb.EPOCH).agg(
        *[F.count_if(F.col("severity") == s.upper()).alias(f"{s}_alerts") for s in ("high", "medium", "low")]
    )
    layers = ep.manifest(spark, root).select(mb.EPOCH, "bronze_rows", "silver_rows")
    return layers.join(gold, mb.EPOCH).join(history, mb.EPOCH).join(alerts, mb.EPOCH)


@query()
def stream_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, dirty_orders(spark, sf_dir), rules=checks.order_suite())
    return ep.committed(spark, root, "history").drop("timestamp")


@query()
def stream_run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, drifting_orders(spark, sf_dir), rules=checks.order_suite())
    return ep.committed(spark, root, "alerts").select(
        "batch_id", "rule_no", "check_name", "column", "level", "previous_level", "change", "severity"
    )


@query()
def stream_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key's uniqueness over all history after every epoch; ids repeat across batches."""
    root = _layered_stream(spark, _straddling(spark, sf_dir))
    return ep.committed(spark, root, "uniqueness")


@query()
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layered_stream(spark, _straddling(spark, sf_dir))
    return ep.stored_rejects(spark, root).withColumn("reasons", F.array_join("reasons", "|"))


@query()
def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all that has arrived, merged from the snapshots of the epochs."""
    root = _layered_stream(spark, dirty_orders(spark, sf_dir), profiled=True)
    merged = merge_snapshots(ep.committed(spark, root, "snapshots"))
    shown = profile_of_snapshot(merged).filter(~F.col("column").isin("src_key", "batch_id"))
    return shown.select(*[c for c in PROFILE_COLUMNS if c != "distinct_count"])


@query()
def stream_running_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per epoch as the running query reports them, and as the manifest has them."""
    root = work_path(spark, "stream-running")
    landing = _landed(spark, dirty_orders(spark, sf_dir), root)
    told = ep.run_for(spark, landing, root, _keep(), every="0 seconds", epochs=BATCHES)
    progress = spark.createDataFrame([(p[mb.EPOCH], p["input_rows"]) for p in told], "epoch long, input_rows long")
    return progress.join(ep.manifest(spark, root).drop("files"), mb.EPOCH)  # a row per epoch

@query()
def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, then two more, then nothing new: each file is read once."""
    orders, root = dirty_orders(spark, sf_dir), work_path(spark, "stream-restart")
    for batches in ([0, 1, 2], [3, 4]):
        stream = _arrive(spark, orders, f"{root}/landing", batches)
        mb.stream_checks(stream, checks.order_suite(), root)
    mb.stream_checks(stream, checks.order_suite(), root)
    bronze = mb.read_epochs(spark, root, "bronze")
    return bronze.groupBy(mb.EPOCH, "batch_id").agg(F.count("*").alias("rows"))


@query()
def stream_drift_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All failures of the arrived batches with their grade."""
    root = _checked_stream(spark, drifting_orders(spark, sf_dir))
    alerts = mb.drift_alerts(spark, root, first_day=FIRST_BATCH_DAY)
    return alerts.select(
        "batch_id", "rule_no", "check_name", "column", "level", "previous_level", "change", "severity"
    )


@query()
def dedup_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of every customer: many rows per key."""
    order = [F.desc("order_date"), F.desc("order_amount"), F.asc("src_key")]
    return keep_first(clean_orders(spark, sf_dir), ["customer_id"], order)
