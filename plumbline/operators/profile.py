"""Column profiles: nulls, distinct values, numeric statistics, top values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import comparable, quoted, text_literal
from ..functions.numeric import rate, round_to
from ..schemas import AUDIT_COLUMNS

# Statistics of a column and their types in the result.
_PARTS = {
    "nulls": "BIGINT",
    "min": "DOUBLE",
    "max": "DOUBLE",
    "mean": "DOUBLE",
    "stddev": "DOUBLE",
    "first_day": "DATE",
    "last_day": "DATE",
    "distinct_count": "BIGINT",
}


def profiled_columns(df: DataFrame, exclude: Sequence[str] = AUDIT_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in exclude]


def counted_columns(df: DataFrame, exclude: Sequence[str] = AUDIT_COLUMNS) -> list[str]:
    """Profiled columns whose values can be told apart; maps and variants only have rows and nulls."""
    return [c for c in profiled_columns(df, exclude) if comparable(df.schema[c].dataType)]


def _text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def column_statistics(
    df: DataFrame, *, exclude: Sequence[str] = AUDIT_COLUMNS, approx_distinct: bool = False
) -> DataFrame:
    """One row per column from a single aggregate over one scan.

    Every task sends one row, whatever the data looks like. Numeric columns get
    min, max, mean and sample standard deviation to two places, and their exact
    bounds; date and time columns their first and last day. ``approx_distinct``
    adds a sketched distinct count, which fits into the same pass.
    """
    aggregates, rows = ["count(*) AS total_rows"], []
    for i, name in enumerate(profiled_columns(df, exclude)):
        column, kind = quoted(name), df.schema[name].dataType
        wanted = {"nulls": f"count_if({column} IS NULL)"}
        if isinstance(kind, T.NumericType):
            wanted |= {
                "min": f"min({column})",
                "max": f"max({column})",
                "mean": f"avg(CAST({column} AS DOUBLE))",
                "stddev": f"stddev_samp(CAST({column} AS DOUBLE))",
            }
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            wanted |= {"first_day": f"min({column})", "last_day": f"max({column})"}
        if approx_distinct and comparable(kind):
            wanted["distinct_count"] = (
                f"approx_count_distinct({column}) + coalesce(max(int({column} IS NULL)), 0)"
            )
        aggregates += [f"{value} AS {part}_{i}" for part, value in wanted.items()]
        fields = [f"{i} AS position", f"{text_literal(name)} AS column"]
        fields.append(f"{text_literal(kind.simpleString())} AS data_type")
        for part, type_name in _PARTS.items():
            if part != "distinct_count" or approx_distinct:
                value = f"{part}_{i}" if part in wanted else "NULL"
                fields.append(f"CAST({value} AS {type_name}) AS {part}")
        rows.append(f"struct({', '.join(fields)})")
    stats = df.selectExpr(*aggregates).selectExpr("total_rows", f"inline(array({', '.join(rows)}))")
    return stats.select(
        "position",
        "column",
        "data_type",
        "total_rows",
        F.col("nulls").alias("null_count"),
        rate(F.col("nulls"), F.col("total_rows")).alias("null_rate"),
        *[round_to(F.col(s), 2).alias(s) for s in ("min", "max", "mean", "stddev")],
        F.col("min").alias("lowest"),
        F.col("max").alias("highest"),
        "first_day",
        "last_day",
        *(["distinct_count"] if approx_distinct else []),
    )


# Bytes up to which a text is its own key when values are counted; longer ones go by their SHA-256.
KEY_BYTES = 64
# Characters at the front of a text that settle most ties between equally frequent ones.
FRONT = 32


def _counts(name: str, text: bool = False) -> str:
    """How often each value of one column occurs.

    Only this column is read. Rows are counted before the shuffle, so a value
    held by a third of all rows is one row per task. NULL is a value. Texts are counted by a
    short ``key``, so whole ones are not shuffled; ``place`` sorts them as far as their front does,
    NULL last.
    """
    column = _plain(quoted(name))
    if not text:
        return f"(SELECT {column} AS value, count(*) AS rows FROM {{df}} GROUP BY ALL)"
    return f"""(SELECT {_key(column)} AS key, {_place(column)} AS place, count(*) AS rows FROM {{df}} GROUP BY ALL)"""


def _key(column: str) -> str:
    short = f"octet_length({column}) <= {KEY_BYTES}"
    return f"CASE WHEN {short} THEN concat('v', {column}) WHEN {column} IS NOT NULL THEN concat('d', sha2({column}, 256)) END"


def _place(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '1' ELSE concat('0', left({column}, {FRONT})) END"


def _best(name: str, k: int) -> str:
    """The ``k`` most frequent values of a text column, and how often they occur.

    The worst of the first ``k`` by number and front says which keys can be among them: those
    before it, and those that tie with it in both. Whole texts are looked up for these alone, where the key
    is not the text itself.
    """
    column, counts = _plain(quoted(name)), _counts(name, text=True)
    worst = f"(SELECT max(struct(-rows AS fewer, place)) FROM (SELECT * FROM {counts} ORDER BY rows DESC, place LIMIT {int(k)}))"
    near = f"(SELECT key, rows FROM {counts} WHERE struct(-rows AS fewer, place) <= {worst})"
    long = f"(SELECT {column} AS value, {_key(column)} AS key FROM {{df}} WHERE octet_length({column}) > {KEY_BYTES})"
    return f"""SELECT value, rows FROM (
        SELECT substring(key, 2) AS value, rows FROM {near} WHERE key IS NULL OR startswith(key, 'v')
        UNION ALL
        SELECT min(value) AS value, max(rows) AS rows FROM {long} JOIN {near} USING (key) GROUP BY key
    ) ORDER BY rows DESC, value NULLS LAST LIMIT {int(k)}"""


def _plain(text: str) -> str:
    """Text whose braces are no place holders of ``spark.sql``."""
    return text.replace("{", "{{").replace("}", "}}")


def _label(name: str) -> str:
    return f"{_plain(text_literal(name))} AS column"


def distinct_counts(
    df: DataFrame,
    *,
    exclude: Sequence[str] = AUDIT_COLUMNS,
    counted: Sequence[str] = (),
) -> DataFrame:
    """Exact number of distinct values per column; NULL counts as a value.

    Each column is a branch of its own, which reads and shuffles its distinct
    values only. Counting all columns at once would multiply the rows by the
    number of columns. Columns in ``counted`` are taken from their value counts,
    so that they share the shuffle of their top values.
    """

    def of(name: str) -> str:
        if name not in counted:
            distinct = f"(SELECT DISTINCT {_plain(quoted(name))} FROM {{df}})"
            return f"SELECT {_label(name)}, count(*) AS distinct_count FROM {distinct}"
        # Summing the rows keeps them in the plan, as the top values need them.
        return f"""SELECT {_label(name)}, distinct_count FROM (
            SELECT count(*) AS distinct_count, coalesce(sum(rows), 0) AS rows FROM {_counts(name, text=True)}
        ) WHERE rows >= 0"""

    branches = [of(name) for name in counted_columns(df, exclude)]
    if not branches:
        return df.sparkSession.createDataFrame([], "column string, distinct_count bigint")
    return df.sparkSession.sql("\nUNION ALL\n".join(branches), df=df)


def top_values(df: DataFrame, k: int = 5, *, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` most frequent values of each text column: ``column, rank, value, rows``.

    Equally frequent values are ranked in value order, NULL last. Every task
    keeps its best ``k`` keys in a heap; only these are brought together, and long texts
    are looked up for the keys that come into question.
    """
    names = _text_columns(df, profiled_columns(df)) if columns is None else columns
    if not names:
        empty = "column string, rank int, value string, rows bigint"
        return df.sparkSession.createDataFrame([], empty)
    branches = [
        f"(SELECT {_label(name)}, value, rows FROM ({_best(name, k)}))" for name in names
    ]
    # At most k rows per column are left to be ranked.
    best = "\nUNION ALL\n".join(branches)
    order = "PARTITION BY column ORDER BY rows DESC, value NULLS LAST"
    ranked = f"SELECT column, row_number() OVER ({order}) AS rank, value, rows FROM ({best})"
    return df.sparkSession.sql(ranked, df=df)


def profile(
    df: DataFrame,
    *,
    exclude: Sequence[str] = AUDIT_COLUMNS,
    top_k: int = 5,
    approx_distinct: bool = False,
) -> DataFrame:
    """One row per column: counts, rates, statistics, ``top_values`` of text columns.

    Give it a stored layer: the plan reads the input once for the statistics
    and once, column by column, for the distinct counts. With
    ``approx_distinct`` and ``top_k=0`` the statistics pass is all there is.
    """
    texts = _text_columns(df, profiled_columns(df, exclude)) if top_k else []
    result = column_statistics(df, exclude=exclude, approx_distinct=approx_distinct)
    # The joined sides have one row per column of the schema.
    if not approx_distinct:
        distinct = distinct_counts(df, exclude=exclude, counted=texts)
        result = result.join(F.broadcast(distinct), "column", "left")
    if texts:
        ranked = F.array_sort(F.collect_list(F.struct("rank", "value")))
        best = top_values(df, top_k, columns=texts).groupBy("column").agg(
            F.transform(ranked, lambda r: r["value"]).alias("top_values")
        )
        result = result.join(best, "column", "left")
    else:
        result = result.withColumn("top_values", F.lit(None).cast("array<string>"))
    return result.select(
        "position",
        "column",
        "data_type",
        "total_rows",
        "null_count",
        "null_rate",
        "distinct_count",
        "min",
        "max",
        "mean",
        "stddev",
        "lowest",
        "highest",
        "first_day",
        "last_day",
        "top_values",
    )
