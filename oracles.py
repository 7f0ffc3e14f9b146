"""The catalog queries as plain SQL, for comparison in another engine."""

from __future__ import annotations

import itertools

from plumbline.sources.bridge import ROOT_CAUSE_ANSWER, RULE_SET_ANSWER

AS_OF = "DATE '2001-12-31'"
FIRST_DAY = "DATE '2001-12-27'"

ORDER_COLUMNS = (
    "order_id, customer_id, order_amount, order_date, product_category, payment_method, "
    "delivery_status, customer_age"
)
TRACKED = f"src_key, {ORDER_COLUMNS}, batch_id"

CLEAN = """clean AS (
 SELECT o_orderkey AS src_key, CAST(o_orderkey AS VARCHAR) AS order_id,
  CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS order_amount,
  CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Books' ELSE 'Food' END AS product_category,
  CASE o_orderkey % 3 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Card' ELSE 'COD' END AS payment_method,
  CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'Cancelled' END AS delivery_status,
  CAST(18 + o_custkey % 62 AS INTEGER) AS customer_age,
  (o_orderkey // 50) % 5 AS batch_id
 FROM orders)"""


def _faulty(name: str, missing: str) -> str:
    return f"""{name} AS (
 SELECT src_key,
  CASE WHEN src_key % 50 = 49 THEN CAST(src_key - 1 AS VARCHAR) ELSE order_id END AS order_id,
  customer_id,
  CASE WHEN (31 * src_key) % 20 = 3 THEN -abs(order_amount) ELSE order_amount END AS order_amount,
  CASE WHEN (37 * src_key) % 100 < 3 THEN CAST(order_date + INTERVAL 40 YEAR AS DATE) ELSE order_date END AS order_date,
  CASE WHEN (41 * src_key) % 100 < 7 THEN 'Unknown' ELSE product_category END AS product_category,
  CASE WHEN {missing} THEN NULL ELSE payment_method END AS payment_method,
  delivery_status, customer_age, batch_id
 FROM clean)"""


DIRTY = f"{CLEAN},\n" + _faulty("dirty", "(43 * src_key) % 100 < 15")
MISSING_PAYMENT = "(43 * src_key) % 100 < CASE WHEN batch_id = 3 THEN 34 ELSE 1 END"
DRIFTING = f"{CLEAN},\n" + _faulty("drifting", MISSING_PAYMENT)

SURVIVORS = """ORDER BY order_amount DESC, order_date NULLS FIRST, product_category NULLS FIRST,
   payment_method NULLS LAST, customer_id NULLS FIRST, src_key"""
UNIQUE = f"""deduplicated AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id {SURVIVORS}) AS rn FROM dirty) WHERE rn = 1)"""

CONDITIONS = {
    "order_amount": "order_amount > 0",
    "order_date": f"order_date <= {AS_OF}",
    "product_category": "product_category IN ('Electronics', 'Clothing', 'Books', 'Food')",
    "payment_method": "payment_method IN ('UPI', 'Card', 'COD')",
    "delivery_status": "delivery_status IN ('Delivered', 'Pending', 'Cancelled')",
    "customer_age": "customer_age BETWEEN 18 AND 100",
}


def _silver_of(source: str) -> str:
    return f"""silver AS (
 SELECT * REPLACE (CAST(CAST(order_amount AS DECIMAL(18,2)) AS DOUBLE) AS order_amount)
 FROM {source} WHERE {" AND ".join(CONDITIONS.values())})"""


def _judged(source: str, more: str = "") -> str:
    reasons = ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in CONDITIONS.items())
    valid = " AND ".join(f"coalesce({c}, false)" for c in CONDITIONS.values())
    return f"""SELECT {TRACKED.replace("order_amount", f"CASE WHEN {valid} THEN CAST(CAST(order_amount AS DECIMAL(18,2)) AS DOUBLE) ELSE order_amount END AS order_amount")},
 concat_ws('|', {reasons}) AS reasons{more} FROM {source}"""


SILVER = f"{DIRTY},\n{UNIQUE},\n{_silver_of('deduplicated')}"

MONEY = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
REVENUE = f"""SELECT product_category, {MONEY.format("order_amount")} AS total_revenue,
 count(order_id) AS total_orders,
 {MONEY.format("order_amount")} / count(order_amount) AS avg_order_value
FROM silver GROUP BY product_category"""
DAILY = f"""SELECT order_date, count(order_id) AS order_count,
 {MONEY.format("order_amount")} AS daily_revenue FROM silver GROUP BY order_date"""


def rounded(value: str, places: int) -> str:
    scale = f"{10**places}.0"
    return f"floor(({value}) * CAST({scale} AS DOUBLE) + 0.5) / CAST({scale} AS DOUBLE)"


def rate(part: str, whole: str) -> str:
    return rounded(f"CAST({part} AS DOUBLE) / nullif({whole}, 0)", 4)


# --- checks ---

# rule type, column, measured count, kind of result
ACCEPTED = {
    "product_category": "('Electronics', 'Clothing', 'Books', 'Food')",
    "payment_method": "('UPI', 'Card', 'COD')",
    "delivery_status": "('Delivered', 'Pending', 'Cancelled')",
}
NAMES = {
    "not_null": "expect_not_null",
    "unique": "expect_unique",
    "value_range": "expect_value_range",
    "accepted_values": "expect_accepted_values",
    "null_rate": "expect_null_rate_below",
}


def _not_null(column: str) -> tuple:
    return ("not_null", column, f"count(*) FILTER (WHERE {column} IS NULL)", None)


def _failing(kind: str, column: str, condition: str) -> tuple:
    return (kind, column, f"count(*) FILTER (WHERE {condition})", None)


def _unique(column: str) -> tuple:
    nulls = f"max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)"
    return ("unique", column, f"count(DISTINCT {column}) + coalesce({nulls}, 0)", None)


def _null_rate(column: str, ceiling: float) -> tuple:
    return ("null_rate", column, f"count(*) FILTER (WHERE {column} IS NULL)", ceiling)


def _accepted(column: str) -> tuple:
    return _failing("accepted_values", column, f"{column} NOT IN {ACCEPTED[column]}")


ORDER_SUITE = [
    _not_null("order_id"),
    _unique("order_id"),
    _not_null("customer_id"),
    _failing("value_range", "order_amount", "order_amount < 0"),
    _failing("value_range", "customer_age", "customer_age NOT BETWEEN 18 AND 100"),
    _accepted("product_category"),
    _accepted("payment_method"),
    _accepted("delivery_status"),
    _null_rate("payment_method", 0.05),
]


def suite(source: str, rules: list[tuple], dataset: str = "orders", by: str = "") -> str:
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    selects = []
    for number, (kind, column, measure, ceiling) in enumerate(rules, start=1):
        share = rate("m", "n")
        if kind == "unique":
            outcome = "m = n AS success, CAST(m AS DOUBLE) AS metric_value, CAST(n AS DOUBLE) AS threshold"
        elif kind == "null_rate":
            outcome = (
                f"{share} <= {ceiling} AS success, {share} AS metric_value, "
                f"CAST({ceiling} AS DOUBLE) AS threshold"
            )
        else:
            outcome = f"m = 0 AS success, {share} AS metric_value, CAST(0 AS DOUBLE) AS threshold"
        selects.append(
            f"SELECT {group}n AS total_rows, CAST({number} AS INTEGER) AS rule_no, '{NAMES[kind]}' AS check_name, "
            f"'{column}' AS column, '{kind}' AS rule_type, {outcome}, "
            f"CAST(NULL AS VARCHAR) AS message, '{dataset}' AS dataset_name "
            f"FROM (SELECT {group}count(*) AS n, CAST({measure} AS BIGINT) AS m FROM {source}{tail})"
        )
    return "\nUNION ALL\n".join(selects)


BATCH_RESULTS = f"results AS ({suite('dirty', ORDER_SUITE, by='batch_id')})"
HISTORY = f"""{DIRTY}, {BATCH_RESULTS}, history AS (
 SELECT dataset_name, check_name AS "check", "column", CASE WHEN success THEN 'PASS' ELSE 'FAIL' END AS status,
  metric_value AS metric, {FIRST_DAY} + CAST(batch_id AS INTEGER) AS day,
  strftime({FIRST_DAY} + CAST(batch_id AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS "timestamp",
  'batch_' || batch_id AS batch FROM results)"""
HISTORY_ROWS = 'SELECT dataset_name, "check", "column", status, metric, "timestamp", batch FROM history'


# --- profile ---


def profile(source: str, columns: dict[str, str], name: str = "profile") -> str:
    """CTEs with one row per column; ``columns`` maps names to text, number or date."""
    selects = []
    for position, (column, kind) in enumerate(columns.items()):
        number = f"CAST({column} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
        day = f"CAST({column} AS DATE)" if kind == "date" else "CAST(NULL AS DATE)"
        selects.append(
            f"""SELECT {position} AS position, '{column}' AS "column", count(*) AS total_rows,
 count(*) FILTER (WHERE {column} IS NULL) AS null_count,
 {rate(f"count(*) FILTER (WHERE {column} IS NULL)", "count(*)")} AS null_rate,
 count(DISTINCT {column}) + CAST(coalesce(max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS distinct_count,
 {rounded(f"min({number})", 2)} AS min, {rounded(f"max({number})", 2)} AS max,
 {rounded(f"avg({number})", 2)} AS mean, {rounded(f"stddev_samp({number})", 2)} AS stddev,
 min({number}) AS lowest, max({number}) AS highest,
 min({day}) AS first_day, max({day}) AS last_day FROM {source}"""
        )
    return f"{name} AS ({' UNION ALL '.join(selects)})"


ORDER_KINDS = {
    "order_id": "text",
    "customer_id": "text",
    "order_amount": "number",
    "order_date": "date",
    "product_category": "text",
    "payment_method": "text",
    "delivery_status": "text",
    "customer_age": "number",
}
TEXTS = [c for c, kind in ORDER_KINDS.items() if kind == "text"]


def tops(source: str, k: int, name: str = "tops", texts: list[str] = TEXTS) -> str:
    counts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS rows FROM {source} GROUP BY {c}"""
        for c in texts
    )
    return f"""{name} AS (SELECT * FROM (
 SELECT "column", CAST(row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, value NULLS LAST) AS INTEGER) AS rank,
  value, rows FROM ({counts})) WHERE rank <= {k})"""


PROFILE_ROWS = """SELECT "column", total_rows, null_count, null_rate, distinct_count, min, max, mean, stddev,
 first_day, last_day, top_values
FROM profile LEFT JOIN (
 SELECT "column", string_agg(coalesce(value, '<null>'), '|' ORDER BY rank) AS top_values FROM tops GROUP BY "column"
) USING ("column")"""

LINE_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]

LINE_KINDS = {
    **dict.fromkeys(LINE_NUMBERS, "number"),
    "l_returnflag": "text",
    "l_linestatus": "text",
    "l_shipdate": "date",
}
DOCUMENT_KINDS = {
    "doc_id": "number",
    "text": "text",
    "lang": "text",
    "source": "text",
    "n_chars": "number",
}


def table_profile(source: str, kinds: dict[str, str]) -> str:
    texts = [c for c, kind in kinds.items() if kind == "text"]
    return f"WITH {profile(source, kinds)}, {tops(source, 5, texts=texts)} {PROFILE_ROWS}"


SUGGESTED = f"""{profile("{source}", ORDER_KINDS)}, {tops("{source}", 10000)},
listed AS (SELECT "column", string_agg(value, '|' ORDER BY value) AS accepted,
  string_agg('"' || value || '"', ',' ORDER BY value) AS accepted_json
 FROM tops WHERE value IS NOT NULL GROUP BY "column"),
candidates AS (
 SELECT position, 0 AS place, "column", 'not_null' AS rule_type, NULL AS min_value, NULL AS max_value, NULL AS accepted,
  NULL AS accepted_json, NULL AS max_null_rate, 'no NULL in ' || total_rows || ' rows' AS reasoning FROM profile WHERE null_count = 0
 UNION ALL
 SELECT position, 1, "column", 'null_rate', NULL, NULL, NULL, NULL, ceil(CAST(null_count * 100 AS DOUBLE) / total_rows) / 100,
  null_count || ' NULL in ' || total_rows || ' rows' FROM profile WHERE null_count > 0
 UNION ALL
 SELECT position, 2, "column", 'unique', NULL, NULL, NULL, NULL, NULL, 'every value differs in ' || total_rows || ' rows'
 FROM profile WHERE distinct_count = total_rows
 UNION ALL
 SELECT position, 3, "column", 'value_range', lowest, highest, NULL, NULL, NULL, 'bounds seen in ' || total_rows || ' rows'
 FROM profile WHERE lowest IS NOT NULL
 UNION ALL
 SELECT position, 4, "column", 'accepted_values', NULL, NULL, accepted, accepted_json, NULL,
  distinct_count || ' distinct values in ' || total_rows || ' rows' FROM profile JOIN listed USING ("column")
 WHERE distinct_count <= 0.01 * total_rows AND distinct_count <= 10000),
suggested AS (SELECT position, place, "column", rule_type, CAST(min_value AS DOUBLE) AS min_value, CAST(max_value AS DOUBLE) AS max_value,
 accepted, accepted_json, CAST(max_null_rate AS DOUBLE) AS max_null_rate, reasoning FROM candidates)"""


def suggested(source: str) -> str:
    return SUGGESTED.replace("{source}", source)


RULE_JSON = """'{"column":"' || "column" || '","rule_type":"' || rule_type || '","parameters":{' ||
 CASE WHEN min_value IS NOT NULL THEN '"min_value":' || min_value || ',"max_value":' || max_value
  WHEN accepted_json IS NOT NULL THEN '"accepted":[' || accepted_json || ']'
  WHEN max_null_rate IS NOT NULL THEN '"max_null_rate":' || max_null_rate ELSE '' END ||
 '},"reasoning":"' || reasoning || '"}'"""

PROFILE_JSON = """profile_docs AS (
 SELECT position, "column", '{"column":"' || "column" || '","total_rows":' || total_rows || ',"null_rate":' || null_rate ||
  ',"null_count":' || null_count || ',"distinct_count":' || distinct_count ||
  CASE WHEN min IS NULL THEN '' ELSE ',"min":' || min || ',"max":' || max || ',"mean":' || mean || ',"stddev":' || stddev END ||
  CASE WHEN top_json IS NULL THEN '' ELSE ',"top_values":[' || top_json || ']' END || '}' AS profile_json
 FROM profile LEFT JOIN (
  SELECT "column", string_agg(coalesce('"' || value || '"', 'null'), ',' ORDER BY rank) AS top_json FROM tops GROUP BY "column"
 ) USING ("column"))"""
SAMPLE_JSON = """sample_docs AS (
 SELECT md5(CAST(src_key AS VARCHAR)) AS pick, '{"src_key":' || src_key || ',"order_id":"' || order_id || '","customer_id":"' || customer_id ||
  '","order_amount":' || order_amount || ',"order_date":"' || order_date || '","product_category":"' || product_category || '"' ||
  coalesce(',"payment_method":"' || payment_method || '"', '') || ',"delivery_status":"' || delivery_status ||
  '","customer_age":' || customer_age || ',"batch_id":' || batch_id || '}' AS row_json
 FROM dirty ORDER BY pick, src_key LIMIT 20)"""
PROMPT_HEAD = (
    "Suggest data quality rules for the dataset orders.' || chr(10) || 'Use only these rule types: not_null, unique, "
    "value_range, accepted_values, null_rate.' || chr(10) || 'Answer with one JSON object with the fields "
    "dataset_name, rules and summary. Each rule has the fields column, rule_type, parameters and reasoning."
)
PROFILED = f"{DIRTY}, {profile('dirty', ORDER_KINDS)}, {tops('dirty', 5)}"

# --- answers ---

BODY = (
    r"trim(regexp_replace(trim(response, chr(32) || chr(10)), '^```(json)?|```$', '', 'g'), chr(32) || chr(10))"
)
RULE_TYPES = "('not_null', 'unique', 'value_range', 'accepted_values', 'null_rate')"
NUMBERS = "('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')"
UNFIT = f"""CASE json_extract_string(rule, '$.rule_type')
  WHEN 'value_range' THEN NOT (
   coalesce(json_type(rule, '$.parameters.min_value'), 'NULL') IN ('NULL', {NUMBERS[1:-1]})
   AND coalesce(json_type(rule, '$.parameters.max_value'), 'NULL') IN ('NULL', {NUMBERS[1:-1]})
   AND (coalesce(json_type(rule, '$.parameters.min_value'), 'NULL') <> 'NULL'
    OR coalesce(json_type(rule, '$.parameters.max_value'), 'NULL') <> 'NULL'))
  WHEN 'accepted_values' THEN coalesce(json_type(rule, '$.parameters.accepted'), '') <> 'ARRAY'
  WHEN 'null_rate' THEN coalesce(json_type(rule, '$.parameters.max_null_rate'), '') NOT IN {NUMBERS}
  ELSE false END"""
RULE_SETS = f"""WITH answers AS (SELECT o_orderkey AS answer_id, {RULE_SET_ANSWER} AS response FROM orders),
bodies AS (SELECT answer_id, {BODY} AS body FROM answers),
docs AS (SELECT answer_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS doc FROM bodies),
checked AS (SELECT answer_id, doc, json_extract_string(doc, '$.dataset_name') AS dataset_name,
 CASE WHEN doc IS NULL THEN 'not JSON' WHEN json_type(doc) <> 'OBJECT' THEN 'not an object'
  WHEN coalesce(json_type(doc, '$.dataset_name'), '') <> 'VARCHAR' THEN 'dataset_name'
  WHEN coalesce(json_type(doc, '$.rules'), '') <> 'ARRAY' THEN 'rules'
  WHEN coalesce(json_type(doc, '$.summary'), '') <> 'VARCHAR' THEN 'summary' END AS answer_problem FROM docs),
rules AS (SELECT answer_id, dataset_name, CAST(i AS INTEGER) AS rule_no, json_extract(doc, '$.rules[' || (i - 1) || ']') AS rule
 FROM (SELECT answer_id, dataset_name, doc, unnest(range(1, CAST(json_array_length(doc, '$.rules') AS BIGINT) + 1)) AS i
  FROM checked WHERE answer_problem IS NULL))
SELECT answer_id, dataset_name, rule_no, json_extract_string(rule, '$.column') AS "column",
 json_extract_string(rule, '$.rule_type') AS rule_type,
 TRY_CAST(json_extract_string(rule, '$.parameters.min_value') AS DOUBLE) AS min_value,
 TRY_CAST(json_extract_string(rule, '$.parameters.max_value') AS DOUBLE) AS max_value,
 array_to_string(json_extract_string(rule, '$.parameters.accepted[*]'), '|') AS accepted_text,
 TRY_CAST(json_extract_string(rule, '$.parameters.max_null_rate') AS DOUBLE) AS max_null_rate,
 json_extract_string(rule, '$.reasoning') AS reasoning,
 CASE WHEN json_extract_string(rule, '$.rule_type') NOT IN {RULE_TYPES} THEN 'rule type' WHEN {UNFIT} THEN 'parameters' END AS problem
FROM rules
UNION ALL
SELECT answer_id, dataset_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, answer_problem
FROM checked WHERE answer_problem IS NOT NULL OR json_array_length(doc, '$.rules') = 0"""
RULE_SETS = (
    f"SELECT * EXCLUDE (accepted_text), nullif(accepted_text, '') AS accepted FROM ({RULE_SETS})"
)

CAUSE_TEXTS = ("failed_check", "column", "explanation", "recommended_investigation", "severity")
ROOT_CAUSES = f"""WITH answers AS (SELECT o_orderkey AS answer_id, {ROOT_CAUSE_ANSWER} AS response FROM orders),
bodies AS (SELECT answer_id, {BODY} AS body FROM answers),
docs AS (SELECT answer_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS doc FROM bodies),
checked AS (SELECT answer_id, doc, TRY_CAST(json_extract_string(doc, '$.confidence') AS DOUBLE) AS confidence,
 CASE WHEN doc IS NULL THEN 'not JSON' WHEN json_type(doc) <> 'OBJECT' THEN 'not an object'
  {" ".join(f"WHEN coalesce(json_type(doc, '$.{c}'), '') <> 'VARCHAR' THEN '{c}'" for c in CAUSE_TEXTS)}
  WHEN coalesce(json_type(doc, '$.confidence'), '') NOT IN {NUMBERS} THEN 'confidence'
  WHEN coalesce(TRY_CAST(json_extract_string(doc, '$.confidence') AS DOUBLE) NOT BETWEEN 0 AND 1, true) THEN 'confidence'
  WHEN json_extract_string(doc, '$.severity') NOT IN ('HIGH', 'MEDIUM', 'LOW') THEN 'severity' END AS problem FROM docs)
SELECT answer_id, {", ".join(f'''CASE WHEN problem IS NULL THEN json_extract_string(doc, '$.{c}') END AS "{c}"''' for c in CAUSE_TEXTS)},
 CASE WHEN problem IS NULL THEN confidence END AS confidence, problem FROM checked"""

# --- drift ---

DRIFT = f"""{DRIFTING}, results AS ({suite('drifting', ORDER_SUITE, by='batch_id')}),
levels AS (SELECT *, CASE WHEN rule_type = 'unique' THEN {rate('metric_value', 'total_rows')} ELSE metric_value END AS level,
 {FIRST_DAY} + CAST(batch_id AS INTEGER) AS batch_date FROM results),
lagged AS (SELECT *, lag(level) OVER w AS previous_level, lag(total_rows) OVER w AS previous_rows, lag(batch_date) OVER w AS previous_date
 FROM levels WINDOW w AS (PARTITION BY rule_no ORDER BY batch_id)),
drift AS (SELECT *, {rounded('level - previous_level', 4)} AS change FROM lagged),
failures AS (SELECT *, CASE WHEN change IS NULL THEN 'MEDIUM'
  WHEN (CASE WHEN rule_type = 'unique' THEN -change ELSE change END) >= 0.20 THEN 'HIGH'
  WHEN (CASE WHEN rule_type = 'unique' THEN -change ELSE change END) >= 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity
 FROM drift WHERE NOT success)"""
MARKER = "CASE severity WHEN 'HIGH' THEN '🔴' WHEN 'MEDIUM' THEN '🟡' WHEN 'LOW' THEN '🟢' ELSE '⚪' END"

FAILING_ROWS = {
    number: {
        "not_null": f"{column} IS NULL",
        "null_rate": f"{column} IS NULL",
        "value_range": {"order_amount": "order_amount < 0", "customer_age": "customer_age NOT BETWEEN 18 AND 100"}.get(column),
        "accepted_values": f"{column} NOT IN {ACCEPTED.get(column)}",
    }[kind]
    for number, (kind, column, _, _) in enumerate(ORDER_SUITE, start=1)
    if kind != "unique"
}


def segments(source: str, failing: dict[int, str], dimensions: list[str], by: str = "") -> str:
    group = f"{by}, " if by else ""
    counted = " UNION ALL ".join(
        f"""SELECT {group}CAST({number} AS INTEGER) AS rule_no, '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS rows,
 count(*) FILTER (WHERE {condition}) AS failing_rows FROM {source} GROUP BY ALL"""
        for number, condition in failing.items()
        for d in dimensions
    )
    return f"""counted AS ({counted}),
totals AS (SELECT {group}dimension, rule_no, CAST(sum(rows) AS BIGINT) AS all_rows, CAST(sum(failing_rows) AS BIGINT) AS all_failing
 FROM counted GROUP BY ALL),
segments AS (SELECT {group}rule_no, dimension, value, rows, failing_rows, {rate('failing_rows', 'all_failing')} AS share,
 {rounded('(CAST(failing_rows AS DOUBLE) / rows) / (CAST(all_failing AS DOUBLE) / all_rows)', 4)} AS lift
 FROM counted JOIN totals USING ({group}dimension, rule_no) WHERE failing_rows > 0)"""


LATTICE_DIMENSIONS = ["product_category", "delivery_status", "order_year", "payment_method"]


def combinations_of(source: str, failing: dict[int, str], dimensions: list[str], sizes: range, least: int, by: str = "") -> str:
    """CTEs with failing rows per combination of dimension values, counted for every set of dimensions."""
    group = f"{by}, " if by else ""
    counted = []
    for size in sizes:
        for names in itertools.combinations(dimensions, size):
            value = f"CAST({names[0]} AS VARCHAR)" if size == 1 else " || ' and ' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in names)
            for n, condition in failing.items():
                counted.append(
                    f"SELECT {group}{n} AS rule_no, {size} AS dimensions, '{' and '.join(names)}' AS dimension, {value} AS value, "
                    f"count(*) AS rows, count(*) FILTER (WHERE {condition}) AS failing_rows FROM {source} "
                    f"GROUP BY {group}{', '.join(names)} HAVING count(*) FILTER (WHERE {condition}) >= {least}"
                )
    totals = "\nUNION ALL ".join(
        f"SELECT {group}{n} AS rule_no, count(*) AS all_rows, count(*) FILTER (WHERE {c}) AS all_failing FROM {source} "
        + (f"GROUP BY {by}" if by else "")
        for n, c in failing.items()
    )
    joined = "\nUNION ALL ".join(counted)
    return f"""counted AS ({joined}), totals AS ({totals}),
combined AS (SELECT {group}rule_no, dimensions, dimension, value, rows, failing_rows, {rate('failing_rows', 'all_failing')} AS share,
 {rounded('(CAST(failing_rows AS DOUBLE) / rows) / (CAST(all_failing AS DOUBLE) / all_rows)', 4)} AS lift
 FROM counted JOIN totals USING ({group}rule_no))"""


LEADING = "ORDER BY lift DESC, failing_rows DESC, dimension, value NULLS LAST"
BATCH_SEGMENTS = (
    "marked AS (SELECT *, count(*) OVER (PARTITION BY batch_id, order_id) > 1 AS repeated FROM drifting), "
    + segments("marked", {**FAILING_ROWS, 2: "repeated"}, ["product_category", "delivery_status"], "batch_id")
)


def _percent(value: str) -> str:
    return f"printf('%.2f%%', {value} * 100)"


REPORT = f"""WITH {DRIFT}, {BATCH_SEGMENTS},
top_segment AS (SELECT batch_id, rule_no, dimension || ' ' || coalesce(value, 'NULL') AS segment, share FROM (
 SELECT *, row_number() OVER (PARTITION BY batch_id, rule_no {LEADING}) AS place FROM segments) WHERE place = 1)
SELECT batch_id, check_name AS failed_check, "column",
 CASE WHEN rule_type = 'unique' THEN 'distinct share of ' ELSE 'failing share of ' END || "column" || ' ' ||
 CASE WHEN previous_level IS NULL THEN 'is ' || {_percent('level')} || ' in the first batch'
  ELSE 'went from ' || {_percent('previous_level')} || ' to ' || {_percent('level')} END ||
 CASE WHEN share IS NULL THEN '' ELSE '; ' || segment || ' holds ' || {_percent('share')} || ' of the failing rows' END AS explanation,
 coalesce(share, 0.0) AS confidence,
 'check the load of ' || strftime(batch_date, '%Y-%m-%d') || CASE WHEN share IS NULL THEN '' ELSE ' for ' || segment END AS recommended_investigation,
 severity, {MARKER} AS marker
FROM failures LEFT JOIN top_segment USING (batch_id, rule_no)"""

SNAPSHOT = """'{{"metric":' || {0} || ',"rows":' || {1} || ',"batch_date":"' || strftime({2}, '%Y-%m-%d') || '"}}'"""
CAUSE_PROMPTS = f"""WITH {DRIFT} SELECT batch_id, check_name, "column",
 'Explain why a data quality check failed.' || chr(10) || 'CHECK ' || check_name || chr(10) || 'COLUMN ' || "column" ||
 chr(10) || 'BEFORE ' || CASE WHEN previous_level IS NULL THEN '{{}}' ELSE {SNAPSHOT.format('previous_level', 'previous_rows', 'previous_date')} END ||
 chr(10) || 'NOW ' || {SNAPSHOT.format('level', 'total_rows', 'batch_date')} || chr(10) ||
 'Answer with one JSON object with the fields failed_check, column, explanation, confidence (0 to 1), ' ||
 'recommended_investigation and severity (HIGH, MEDIUM, LOW).' AS prompt FROM failures"""

def column_drift(source: str, columns: dict[str, str], batch: str) -> str:
    """Rows, NULL share and mean of every column and batch beside the batch before."""
    selects = []
    for column, kind in columns.items():
        number = f"CAST({column} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
        selects.append(
            f"""SELECT {batch}, '{column}' AS "column", count(*) AS rows, {rate(f"count(*) FILTER (WHERE {column} IS NULL)", "count(*)")} AS null_rate,
 avg({number}) AS mean, stddev_pop({number}) AS spread FROM {source} GROUP BY {batch}"""
        )
    return f"""levels AS ({' UNION ALL '.join(selects)}),
before AS (SELECT *, lag(rows) OVER w AS previous_rows, lag(null_rate) OVER w AS previous_null_rate,
 lag(mean) OVER w AS previous_mean, lag(spread) OVER w AS previous_spread FROM levels
 WINDOW w AS (PARTITION BY "column" ORDER BY {batch}))
SELECT {batch}, "column", rows, previous_rows, null_rate, previous_null_rate, {rounded('null_rate - previous_null_rate', 4)} AS null_rate_change,
 {rounded('mean', 2)} AS mean, {rounded('previous_mean', 2)} AS previous_mean, {rounded('(mean - previous_mean) / previous_spread', 2)} AS shift
FROM before"""


# --- dedup across batches: the first batch holding an id keeps it ---

STRADDLING = f"""{CLEAN}, {_faulty('dirty0', "(43 * src_key) % 100 < 15")},
dirty AS (SELECT * REPLACE (CASE WHEN src_key % 50 = 49 THEN (batch_id + 2) % 5 ELSE batch_id END AS batch_id) FROM dirty0),
deduplicated AS (SELECT * EXCLUDE (rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY order_id {SURVIVORS.replace('ORDER BY', 'ORDER BY batch_id,')}) AS rn FROM dirty) WHERE rn = 1),
{_silver_of('deduplicated')}"""

CLEAN_BOUNDS = f"{DIRTY}, {suggested('clean')}"

DEFECTS = [
    # column, declared type, actual type, problem, unreadable cells
    *[(c, t, t, None, "0") for c, t in (("order_id", "string"), ("customer_id", "string"))],
    ("order_amount", "double", "string", "wrong_type", "count(*) FILTER (WHERE src_key % 11 = 0)"),
    ("order_date", "date", "date", None, "0"),
    ("product_category", "string", "string", None, "0"),
    ("payment_method", "string", "string", None, "0"),
    ("delivery_status", "string", None, "missing", "0"),
    ("customer_age", "int", "bigint", "wrong_type", "0"),
    ("src_key", None, "bigint", "extra", "0"),
    ("status", None, "string", "extra", "0"),
    ("batch_id", None, "bigint", "extra", "0"),
]


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


CONTRACT = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {_text(want)} AS declared_type, {_text(have)} AS actual_type, {_text(problem)} AS problem,
 CAST({bad} AS BIGINT) AS unreadable_cells, count(*) AS total_rows FROM dirty"""
    for c, want, have, problem, bad in DEFECTS
)

FAULTS = {
    "null_payment": "payment_method IS NULL",
    "negative_amount": "order_amount < 0",
    "future_date": f"order_date > {AS_OF}",
    "invalid_category": "coalesce(product_category NOT IN ('Electronics', 'Clothing', 'Books', 'Food'), true)",
}


def _one_sum(source: str, column: str) -> str:
    return f"(SELECT CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE) FROM {source})"


def _suggested_checks() -> str:
    """Every rule that may be suggested from clean orders, kept if it is, run on dirty ones."""
    bound = "(SELECT {0} FROM suggested WHERE \"column\" = '{1}' AND rule_type = 'value_range')"
    listed = "(SELECT value FROM tops WHERE \"column\" = '{0}' AND value IS NOT NULL)"
    rules: list[tuple] = []
    for column, kind in ORDER_KINDS.items():
        rules += [_not_null(column), _unique(column)]
        if kind == "text":
            rules.append(_failing("accepted_values", column, f"{column} NOT IN {listed.format(column)}"))
        if kind == "number":
            low, high = bound.format("min_value", column), bound.format("max_value", column)
            rules.append(_failing("value_range", column, f"{column} < {low} OR {column} > {high}"))
    return f"""SELECT * EXCLUDE (number) REPLACE (number AS rule_no) FROM ({suite("dirty", rules)}) AS results
JOIN (SELECT "column", rule_type, CAST(row_number() OVER (ORDER BY position, rule_type) AS INTEGER) AS number FROM suggested) AS numbered
USING ("column", rule_type)"""


def sql() -> dict[str, str]:
    """Query name to SQL over the test tables."""
    result_columns = (
        "batch_id, rule_no, check_name, \"column\", batch_date, total_rows, previous_rows, level, previous_level, change"
    )
    queries = {
        "csv_bronze_scan": f"WITH {DIRTY} SELECT {ORDER_COLUMNS} FROM dirty",
        "bronze_roundtrip_count": f"WITH {DIRTY} SELECT count(*) AS bronze_rows FROM dirty",
        "bronze_audit_stamp": f"WITH {DIRTY} SELECT count(*) AS bronze_rows, count(*) AS stamped_rows, true AS one_stamp FROM dirty",
        "silver_dedup": f"WITH {DIRTY}, {UNIQUE} SELECT {TRACKED} FROM deduplicated",
        "silver_orders": f"WITH {SILVER} SELECT {TRACKED} FROM silver",
        "silver_rejects": f"WITH {DIRTY}, {UNIQUE} {_judged('deduplicated')}",
        "silver_reject_rate": f"""WITH {SILVER}, counts AS (
 SELECT (SELECT count(*) FROM dirty) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows)
SELECT bronze_rows, silver_rows, {rate('bronze_rows - silver_rows', 'bronze_rows')} AS reject_rate FROM counts""",
        "silver_reject_reasons": f"WITH {DIRTY}, {UNIQUE} "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS reason, count(*) FILTER (WHERE {bad}) AS rejected_rows, "
            f"{rate(f'count(*) FILTER (WHERE {bad})', 'count(*)')} AS share FROM deduplicated"
            for name, bad in {
                **{n: f"NOT coalesce({c}, false)" for n, c in CONDITIONS.items()},
                "any": f"NOT coalesce({' AND '.join(CONDITIONS.values())}, false)",
            }.items()
        ),
        "gold_revenue_by_category": f"WITH {SILVER} {REVENUE}",
        "gold_charge_by_flag": """WITH lines AS (
 SELECT l_returnflag AS c, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS v FROM lineitem),
sums AS (SELECT c, count(*) AS n, sum(CAST(floor(v * 100.0::DOUBLE + 0.5::DOUBLE) AS HUGEINT))::DOUBLE / 100.0::DOUBLE
 + sum(v - floor(v * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE) AS t FROM lines GROUP BY c)
SELECT c AS product_category, n AS total_orders, floor(t * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS total_revenue,
 floor(t / n * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS avg_order_value FROM sums""",
        "parsed_rules_checked": """WITH t AS (SELECT count(*) AS n,
  count(*) FILTER (l_linenumber NOT IN (1, 2, 3)) AS f1, count(*) FILTER (l_tax NOT IN (0::DOUBLE, 0.02::DOUBLE, 0.04::DOUBLE)) AS f2,
  count(*) FILTER (l_quantity <> 1) AS f0, count(*) FILTER (l_quantity < 1 OR l_quantity > 45.5::DOUBLE) AS f3, count(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS f4 FROM lineitem)
SELECT no AS rule_no, kind AS check_name, col AS "column", f = 0 AS success,
 floor(f::DOUBLE / n * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS metric_value,
 0.0::DOUBLE AS threshold, CASE WHEN no = 3 THEN 'accepted value ''many'' does not fit type double' END AS message
FROM t, LATERAL (VALUES (1, 'expect_accepted_values', 'l_linenumber', f1), (2, 'expect_accepted_values', 'l_tax', f2), (3, 'expect_accepted_values', 'l_quantity', f0),
  (4, 'expect_value_range', 'l_quantity', f3), (5, 'expect_accepted_values', 'l_returnflag', f4)) AS x(no, kind, col, f)""",
        "gold_daily_orders": f"WITH {SILVER} {DAILY} ORDER BY order_date",
        "medallion_run": f"""WITH {SILVER}
SELECT 'bronze' AS layer, count(*) AS rows, CAST(NULL AS DOUBLE) AS revenue FROM dirty
UNION ALL SELECT 'silver', count(*), NULL FROM silver
UNION ALL SELECT 'revenue_by_category', count(DISTINCT product_category), {_one_sum('silver', 'order_amount')} FROM silver
UNION ALL SELECT 'daily_orders', count(DISTINCT order_date), {_one_sum('silver', 'order_amount')} FROM silver
UNION ALL SELECT 'profile', 10, NULL""",
        "upsert_by_key": f"""WITH {CLEAN}, both_sides AS (
 SELECT order_id, order_date, order_amount, 1 AS age FROM clean
 UNION ALL SELECT order_id, order_date + (customer_age % 7 - 3), order_amount + 1000, 0 FROM clean WHERE delivery_status = 'Pending')
SELECT order_id, order_date, CAST(CAST(order_amount AS DECIMAL(18,2)) AS DOUBLE) AS order_amount FROM (
 SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC, age) AS rn FROM both_sides) WHERE rn = 1""",
        "dedup_by_customer": f"""WITH {CLEAN} SELECT {TRACKED} FROM (SELECT *, row_number() OVER (
 PARTITION BY customer_id ORDER BY order_date DESC, order_amount DESC, src_key) AS rn FROM clean) WHERE rn = 1""",
        "profile_silver": f"WITH {SILVER}, {profile('silver', ORDER_KINDS)}, {tops('silver', 5)} {PROFILE_ROWS}",
        "profile_from_snapshots": f"""WITH {SILVER}, {profile('silver', ORDER_KINDS)}
SELECT "column", total_rows, null_count, null_rate, min, max, mean, stddev, first_day, last_day FROM profile""",
        "distinct_from_snapshots": f"""WITH {DIRTY}, {profile('dirty', ORDER_KINDS)} SELECT "column", distinct_count, true AS within_error FROM profile""",
        "drift_from_snapshots": f"WITH {DRIFTING}, {column_drift('drifting', ORDER_KINDS, 'batch_id')}",
        "profile_raw": f"WITH {PROFILED} {PROFILE_ROWS}",
        "profile_lineitem": table_profile("lineitem", LINE_KINDS),
        "profile_texts": table_profile("documents", DOCUMENT_KINDS),
        "profile_numeric": f"WITH {profile('lineitem', dict.fromkeys(LINE_NUMBERS, 'number'))} "
        'SELECT "column", total_rows, null_count, min, max, mean, stddev FROM profile',
        "profile_top_values": f"WITH {DIRTY}, {tops('dirty', 5)} SELECT \"column\", rank, value, rows FROM tops",
        "check_not_null": f"WITH {DIRTY} {suite('dirty', [_not_null('order_id'), _not_null('payment_method')])}",
        "check_unique": f"WITH {DIRTY} {suite('dirty', [_unique('order_id'), _unique('src_key'), _unique('payment_method')])}",
        "check_value_range": f"WITH {DIRTY} "
        + suite(
            "dirty",
            [
                _failing("value_range", "order_amount", "order_amount < 0"),
                _failing("value_range", "order_amount", "order_amount > 400000"),
                _failing("value_range", "customer_age", "customer_age NOT BETWEEN 18 AND 100"),
                _failing("value_range", "order_date", f"order_date > {AS_OF}"),
                _failing("value_range", "customer_age", "false"),
            ],
        ),
        "check_accepted_values": f"WITH {DIRTY} "
        + suite(
            "dirty",
            [
                _accepted("product_category"),
                _accepted("payment_method"),
                _failing("accepted_values", "delivery_status", "true"),
            ],
        ),
        "check_null_rate_below": f"WITH {DIRTY} "
        + suite(
            "dirty",
            [_null_rate("payment_method", 0.05), _null_rate("payment_method", 0.15), _null_rate("order_id", 0.0)],
        ),
        "check_suite": f"WITH {DIRTY} {suite('dirty', ORDER_SUITE)}",
        "check_suite_silver": f"WITH {SILVER} {suite('silver', ORDER_SUITE, 'silver_orders')}",
        "check_summary": f"""WITH {DIRTY}, results AS ({suite('dirty', ORDER_SUITE)})
SELECT count(*) AS total_checks, count(*) FILTER (WHERE success) AS passed_checks,
 count(*) FILTER (WHERE NOT success) AS failed_checks FROM results""",
        "check_lines": f"""WITH {DIRTY}, results AS ({suite('dirty', ORDER_SUITE)})
SELECT rule_no, CASE WHEN success THEN 'PASS' ELSE 'FAIL' END || ' | ' || "column" || ' | ' || rule_type || ' | metric=' || metric_value AS line
FROM results""",
        "check_dispatch": f"""WITH {DIRTY}
SELECT count(*) AS total_rows, CAST(1 AS INTEGER) AS rule_no, 'regex_match' AS check_name, 'order_id' AS "column", 'regex_match' AS rule_type,
 false AS success, CAST(NULL AS DOUBLE) AS metric_value, CAST(NULL AS DOUBLE) AS threshold, 'unknown rule type regex_match' AS message,
 'orders' AS dataset_name FROM dirty
UNION ALL SELECT count(*), 2, 'expect_not_null', 'coupon', 'not_null', false, NULL, NULL, 'unknown column coupon', 'orders' FROM dirty
UNION ALL SELECT total_rows, 3, check_name, "column", rule_type, success, metric_value, threshold, message, dataset_name
FROM ({suite('dirty', [_null_rate('payment_method', 0.2)])})""",
        "check_suite_by_batch": f"WITH {DIRTY} {suite('dirty', ORDER_SUITE, by='batch_id')}",
        "check_events_by_day": "WITH daily AS (SELECT *, CAST(ts AS DATE) AS day FROM events) "
        + suite(
            "daily",
            [
                _not_null("user_id"),
                _unique("event_id"),
                _unique("user_id"),
                _failing("value_range", "value", "value < 0 OR value > 50"),
                _failing("accepted_values", "event_type", "event_type NOT IN ('click', 'view', 'purchase')"),
            ],
            "events",
            by="day",
        ),
        "check_result_times": f"""WITH {DIRTY}, {BATCH_RESULTS}
SELECT batch_id, dataset_name, count(*) AS results, count(*) AS timed_results, true AS one_time FROM results GROUP BY ALL""",
        "literal_rates_applied": f"""WITH {CLEAN}, rates(product_category, percent) AS (VALUES ('Electronics', 18), ('Clothing', 5), ('Books', NULL))
SELECT product_category, count(*) AS orders, max(percent) AS percent,
 CAST(sum(CAST(order_amount AS DECIMAL(18,2)) * coalesce(percent, 0)) AS DOUBLE) AS percents_due
FROM clean LEFT JOIN rates USING (product_category) GROUP BY ALL""",
        "schema_drift": f"""WITH {DIRTY}, counts AS (SELECT batch_id AS batch, count(*) AS rows FROM dirty GROUP BY ALL),
changes(batch, version, "column", change, from_type, to_type) AS (VALUES
 (1::BIGINT, 2::BIGINT, 'coupon', 'appeared', NULL, 'string'),
 (3, 3, 'coupon', 'vanished', 'string', NULL), (3, 3, 'delivery_status', 'vanished', 'string', NULL),
 (3, 3, 'order_amount', 'retyped', 'double', 'string'), (3, 3, 'customer_age', 'retyped', 'int', 'bigint'),
 (4, 4, 'delivery_status', 'appeared', NULL, 'string'), (4, 4, 'order_amount', 'retyped', 'string', 'double'),
 (4, 4, 'customer_age', 'retyped', 'bigint', 'int'), (4, 4, 'order_id', 'moved', 'string', 'string'),
 (4, 4, 'customer_id', 'moved', 'string', 'string'))
SELECT batch, version, rows, "column", change, from_type, to_type FROM changes JOIN counts USING (batch)""",
        "check_schema_contract": f"WITH {DIRTY} {CONTRACT}",
        "inject_faults": f"""WITH {CLEAN} SELECT src_key,
 CASE WHEN src_key % 50 = 49 THEN CAST(src_key - 1 AS VARCHAR) ELSE order_id END AS order_id, customer_id,
 CASE WHEN (31 * src_key) % 20 = 3 THEN -abs(order_amount) ELSE order_amount END AS order_amount,
 CASE WHEN (37 * src_key) % 100 < 3 THEN {AS_OF} + CAST(src_key % 59 + 1 AS INTEGER) ELSE order_date END AS order_date,
 CASE WHEN (41 * src_key) % 100 < 7 THEN
  CASE src_key % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'INVALID' WHEN 2 THEN '???' ELSE 'TestCategory' END ELSE product_category END AS product_category,
 CASE WHEN (43 * src_key) % 100 < 15 THEN NULL ELSE payment_method END AS payment_method, delivery_status, customer_age, batch_id FROM clean""",
        "fault_rates": f"WITH {DIRTY} "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS fault, count(*) FILTER (WHERE {bad}) AS faulty_rows, count(*) AS total_rows, "
            f"{rate(f'count(*) FILTER (WHERE {bad})', 'count(*)')} AS rate FROM dirty"
            for name, bad in FAULTS.items()
        )
        + f""" UNION ALL SELECT 'repeated_id', count(*) - count(DISTINCT order_id), count(*),
 {rate('count(*) - count(DISTINCT order_id)', 'count(*)')} FROM dirty""",
        "seeded_sample": f"WITH {CLEAN} SELECT {TRACKED} FROM clean WHERE CAST('0x' || substr(md5(concat(src_key, ':42')), 1, 8) AS BIGINT) % 10000 < 1500",
        "exact_sample": f"""WITH {CLEAN}, placed AS (
 SELECT *, row_number() OVER (ORDER BY md5(concat(src_key, ':42'))) AS place, count(*) OVER () AS total FROM clean)
SELECT {TRACKED} FROM placed WHERE place <= floor(total * 125 / 1000.0 + 0.5)""",
        "suggest_rules": f"""WITH {DIRTY}, {suggested('dirty')}
SELECT position, "column", rule_type, min_value, max_value, accepted, max_null_rate, reasoning FROM suggested""",
        "rules_to_json": f"""WITH {DIRTY}, {suggested('dirty')} SELECT 'orders' AS dataset_name,
 '{{"dataset_name":"orders","rules":[' || string_agg({RULE_JSON}, ',' ORDER BY position, place) || '],"summary":"' || count(*) || ' rules"}}' AS rules_json
FROM suggested""",
        "suggested_rules_checked": f"WITH {CLEAN_BOUNDS} {_suggested_checks()}",
        "profile_to_json": f"WITH {PROFILED}, {PROFILE_JSON} SELECT position, \"column\", profile_json FROM profile_docs",
        "sample_rows_json": f"WITH {DIRTY}, {SAMPLE_JSON} SELECT pick, row_json FROM sample_docs",
        "rule_prompt": f"""WITH {PROFILED}, {PROFILE_JSON}, {SAMPLE_JSON} SELECT 'orders' AS dataset_name,
 '{PROMPT_HEAD}' || chr(10) || 'PROFILE' || chr(10) || (SELECT string_agg(profile_json, chr(10) ORDER BY position) FROM profile_docs) ||
 chr(10) || 'SAMPLE ROWS' || chr(10) || (SELECT string_agg(row_json, chr(10) ORDER BY pick) FROM sample_docs) AS prompt""",
        "parse_ruleset_json": RULE_SETS,
        "parse_root_cause_json": ROOT_CAUSES,
        "parse_rules_over_texts": """SELECT doc_id, CASE WHEN good THEN source END AS dataset_name, CASE WHEN good THEN 1 END AS rule_no,
 CASE WHEN good THEN sha256(text) END AS reasoning_sha256, CASE WHEN good THEN sha256(text) END AS accepted_sha256,
 CASE WHEN NOT good THEN 'not JSON' END AS problem FROM (SELECT *, doc_id % 4 < 2 AS good FROM documents)""",
        "parse_causes_over_texts": """SELECT doc_id, CASE WHEN problem IS NULL THEN lang END AS "column",
 CASE WHEN problem IS NULL THEN sha256(text) END AS explanation_sha256, CASE WHEN problem IS NULL THEN confidence END AS confidence,
 CASE WHEN problem IS NULL THEN severity END AS severity, problem
FROM (SELECT *, CASE WHEN doc_id % 4 > 1 THEN 'not JSON' WHEN confidence > 1 THEN 'confidence' WHEN severity = 'URGENT' THEN 'severity' END AS problem
 FROM (SELECT *, CAST(n_chars % 125 AS DOUBLE) / 100 AS confidence, ['HIGH', 'MEDIUM', 'LOW', 'URGENT'][(doc_id // 4) % 4 + 1] AS severity FROM documents))""",
        "batch_drift": f"WITH {DRIFT} SELECT {result_columns} FROM drift",
        "failure_severity": f"""WITH {DRIFT} SELECT batch_id, rule_no, check_name, "column", level, change, severity, {MARKER} AS marker FROM failures""",
        "failure_attribution": f"""WITH {DRIFTING}, {segments('drifting', {1: 'payment_method IS NULL'}, ['product_category', 'delivery_status', 'batch_id'])}
SELECT dimension, value, rows, failing_rows, share, lift, CAST(row_number() OVER ({LEADING}) AS INTEGER) AS rank
FROM segments ORDER BY rank LIMIT 10""",
        "failure_combinations": f"""WITH {DRIFTING},
marked AS (SELECT *, CAST(year(order_date) AS INTEGER) AS order_year, count(*) OVER (PARTITION BY batch_id, order_id) > 1 AS repeated FROM drifting),
{combinations_of('marked', {1: 'repeated', 2: 'order_amount < 0', 3: 'payment_method IS NULL'}, LATTICE_DIMENSIONS, range(1, 5), 8, 'batch_id')}
SELECT * FROM combined""",
        "failure_pairs": f"""WITH {DRIFTING},
marked AS (SELECT *, CAST(year(order_date) AS INTEGER) AS order_year FROM drifting),
{combinations_of('marked', {1: 'order_amount < 0', 2: 'customer_age NOT BETWEEN 18 AND 100', 3: "product_category NOT IN ('Electronics', 'Clothing', 'Books', 'Food')"}, LATTICE_DIMENSIONS[:3], range(2, 3), 1)}
SELECT * FROM combined""",
        "failure_segments_by_batch": f"""WITH {DRIFTING}, {BATCH_SEGMENTS}
SELECT batch_id, rule_no, dimension, value, rows, failing_rows, share, lift FROM segments""",
        "root_cause_report": REPORT,
        "root_cause_prompt": CAUSE_PROMPTS,
        "monitor_kpis": f"""WITH {HISTORY} SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks,
 count(*) FILTER (WHERE status = 'FAIL') AS failed_checks,
 {rounded("CAST(100 * count(*) FILTER (WHERE status = 'PASS') AS DOUBLE) / count(*)", 1)} AS pass_rate FROM history""",
        "monitor_history": f"""WITH {HISTORY} SELECT *, CASE status WHEN 'PASS' THEN 'green' ELSE 'red' END AS colour FROM ({HISTORY_ROWS})""",
        "monitor_pass_rate_trend": f"""WITH {HISTORY}, days AS (SELECT CAST({AS_OF} - CAST(i AS INTEGER) AS DATE) AS day FROM range(14) AS t(i))
SELECT days.day AS day, count(history.status) AS checks,
 {rate("count(*) FILTER (WHERE history.status = 'PASS')", "count(history.status)")} AS pass_rate
FROM days LEFT JOIN history ON history.day = days.day GROUP BY days.day""",
        "monitor_top_failing_columns": f"""WITH {HISTORY} SELECT "column", count(*) AS failures FROM history WHERE status = 'FAIL' GROUP BY "column" """,
        "failed_checks": f"WITH {HISTORY} {HISTORY_ROWS} WHERE status = 'FAIL'",
        "failed_check_labels": f"""WITH {HISTORY} SELECT batch || ' | ' || "column" || ' | ' || "check" AS label,
 batch AS label_batch, "column" AS label_column, "check" AS label_check FROM history WHERE status = 'FAIL'""",
        "history_rechecked": f"""WITH {DIRTY}, {_faulty("drifting", MISSING_PAYMENT)},
results AS (SELECT * FROM ({suite('dirty', ORDER_SUITE, by='batch_id')}) WHERE batch_id < 4
 UNION ALL SELECT * FROM ({suite('drifting', ORDER_SUITE, by='batch_id')}) WHERE batch_id = 4
 UNION ALL SELECT * FROM ({suite('clean', ORDER_SUITE, by='batch_id', dataset='clean_orders')}))
SELECT dataset_name, 'batch_' || batch_id AS batch, count(*) AS checks, count(*) FILTER (WHERE success) AS passed_checks
FROM results GROUP BY dataset_name, batch_id""",
        "stream_check_suite": f"""WITH {DIRTY} SELECT *, batch_id AS epoch FROM ({suite('dirty', ORDER_SUITE, by='batch_id')})""",
        "stream_medallion": f"WITH {SILVER} SELECT {TRACKED} FROM silver",
        "stream_gold": f"WITH {SILVER} {REVENUE}",
        "stream_daily_orders": f"WITH {SILVER} {DAILY} ORDER BY order_date",
        "stream_dedup_across_batches": f"WITH {STRADDLING} SELECT {TRACKED}, batch_id AS epoch FROM silver",
        "stream_uniqueness": f"""WITH {STRADDLING},
per_epoch AS (SELECT batch_id AS epoch, count(*) AS rows FROM dirty GROUP BY ALL),
fresh AS (SELECT batch_id AS epoch, count(*) AS new_keys FROM deduplicated GROUP BY ALL)
SELECT 'order_id' AS "column", epoch, rows, new_keys, CAST(sum(rows) OVER w AS BIGINT) AS all_rows, CAST(sum(new_keys) OVER w AS BIGINT) AS all_keys,
 sum(rows) OVER w = sum(new_keys) OVER w AS success FROM per_epoch JOIN fresh USING (epoch) WINDOW w AS (ORDER BY epoch)""",
        "stream_rejects": f"""WITH {STRADDLING} SELECT * FROM ({_judged('deduplicated', ', batch_id AS epoch')}) WHERE reasons <> ''""",
        "stream_profile": f"""WITH {DIRTY}, {profile('dirty', ORDER_KINDS)}
SELECT "column", total_rows, null_count, null_rate, min, max, mean, stddev, first_day, last_day FROM profile""",
        "stream_whole_run": f"""WITH {DRIFT},
unique_ids AS (SELECT * EXCLUDE (rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY order_id {SURVIVORS}) AS rn FROM drifting) WHERE rn = 1),
{_silver_of('unique_ids')},
layers AS (SELECT batch_id AS epoch, count(*) AS bronze_rows FROM drifting GROUP BY ALL),
refined AS (SELECT batch_id AS epoch, count(*) AS silver_rows, {MONEY.format("order_amount")} AS revenue FROM silver GROUP BY ALL),
checked AS (SELECT batch_id AS epoch, count(*) FILTER (WHERE success) AS passed_checks, count(*) FILTER (WHERE NOT success) AS failed_checks
 FROM results GROUP BY ALL),
alerted AS (SELECT batch_id AS epoch, count(*) FILTER (WHERE severity = 'HIGH') AS high_alerts,
 count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_alerts, count(*) FILTER (WHERE severity = 'LOW') AS low_alerts FROM failures GROUP BY ALL)
SELECT * FROM layers JOIN refined USING (epoch) JOIN checked USING (epoch) JOIN alerted USING (epoch)""",
        "stream_run_history": f"""WITH {HISTORY} SELECT dataset_name, "check", "column", status, metric, batch,
 CAST(replace(batch, 'batch_', '') AS BIGINT) AS epoch FROM history""",
        "stream_run_alerts": f"""WITH {DRIFT} SELECT batch_id, rule_no, check_name, "column", level, previous_level, change, severity
FROM failures""",
        "stream_running_trigger": f"""WITH {SILVER}
SELECT epoch, input_rows, input_rows AS bronze_rows, silver_rows
FROM (SELECT batch_id AS epoch, count(*) AS input_rows FROM dirty GROUP BY ALL)
JOIN (SELECT batch_id AS epoch, count(*) AS silver_rows FROM silver GROUP BY ALL) USING (epoch)""",
        "stream_incremental": f"""WITH {DIRTY} SELECT CAST(CASE WHEN batch_id < 3 THEN 0 ELSE 1 END AS BIGINT) AS epoch, batch_id, count(*) AS rows
FROM dirty GROUP BY ALL""",
        "stream_drift_alert": f"""WITH {DRIFT} SELECT batch_id, rule_no, check_name, "column", level, previous_level, change, severity
FROM failures""",
    }
    return queries
