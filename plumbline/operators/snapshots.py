"""Profiles that merge: what a batch adds is stored once and never read from the batch again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import comparable, quoted, text_literal
from ..functions.numeric import rate, round_to
from ..schemas import AUDIT_COLUMNS
from .profile import profiled_columns

#: Statistics of a column that a snapshot holds, and their types. ``deviations`` is the sum of squared
#: distances from the mean, ``sketch`` a HyperLogLog sketch of the values.
_PARTS = {
    "nulls": "BIGINT",
    "numbers": "BIGINT",
    "mean": "DOUBLE",
    "deviations": "DOUBLE",
    "lowest": "DOUBLE",
    "highest": "DOUBLE",
    "first_day": "DATE",
    "last_day": "DATE",
    "sketch": "BINARY",
}
LOG_K = 12  # of a sketch: 2^12 registers, 2.5 kB


def sketch_error(log_k: int = LOG_K) -> float:
    """Three standard errors of a sketch's count, as a share of it."""
    return 3 * 1.04 / 2 ** (log_k / 2)


def _wanted(name: str, kind: T.DataType, log_k: int) -> dict[str, str]:
    column = quoted(name)
    wanted = {"nulls": f"count_if({column} IS NULL)"}
    if isinstance(kind, T.NumericType):
        number = f"CAST({column} AS DOUBLE)"
        wanted |= {
            "numbers": f"count({column})",
            "mean": f"avg({number})",
            "deviations": f"var_pop({number}) * count({column})",
            "lowest": f"min({column})",
            "highest": f"max({column})",
        }
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        wanted |= {"first_day": f"min({column})", "last_day": f"max({column})"}
    if comparable(kind):
        wanted["sketch"] = f"hll_sketch_agg({_sketched(name, kind)}, {log_k})"
    return wanted


def _sketched(name: str, kind: T.DataType) -> str:
    """A value as something sketches take: its text, or its JSON where it has none."""
    if isinstance(kind, (T.StringType, T.BinaryType, T.IntegerType, T.LongType)):
        return quoted(name)
    if isinstance(kind, T.AtomicType):
        return f"CAST({quoted(name)} AS STRING)"
    return f"to_json(struct({quoted(name)}))"


def snapshot(
    df: DataFrame, by: str | Sequence[str] = (), *, exclude: Sequence[str] = AUDIT_COLUMNS, log_k: int = LOG_K
) -> DataFrame:
    """One row per column, and per group of ``by`` (a batch, say), of statistics that merge.

    One pass over the rows; a task sends one row per group with a sketch of 2^``log_k`` registers per column, whatever it has
    read. Columns whose values cannot be compared (maps, variants) have rows and nulls.
    """
    groups = [by] if isinstance(by, str) else list(by)
    aggregates, rows = [F.count("*").alias("rows")], []
    for i, name in enumerate(c for c in profiled_columns(df, exclude) if c not in groups):
        kind = df.schema[name].dataType
        wanted = _wanted(name, kind, log_k)
        aggregates += [F.expr(value).alias(f"{part}_{i}") for part, value in wanted.items()]
        fields = [f"{i} AS position", f"{text_literal(name)} AS column", f"{text_literal(kind.simpleString())} AS data_type"]
        for part, kind_name in _PARTS.items():
            fields.append(f"CAST({f'{part}_{i}' if part in wanted else 'NULL'} AS {kind_name}) AS {part}")
        rows.append(f"struct({', '.join(fields)})")
    keys = [F.col(quoted(g)) for g in groups]
    return df.groupBy(*keys).agg(*aggregates).select(*keys, "rows", F.expr(f"inline(array({', '.join(rows)}))"))


def merge_snapshots(parts: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Snapshots of many batches as one, per column and group of ``by``; batches are not read.

    Means and squared deviations of parts combine as those of their union: deviations add, plus each
    part's numbers times the squared distance of its mean from the common mean. That distance is taken from a
    window over the parts, not from sums of squares, which cancel.
    """
    groups = [by] if isinstance(by, str) else list(by)
    keys = [*[quoted(g) for g in groups], "position", "column", "data_type"]
    common = parts.groupBy(*[F.col(k).alias(f"at_{i}") for i, k in enumerate(keys)]).agg(
        (F.sum(F.col("mean") * F.col("numbers")) / F.sum("numbers")).alias("common")
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"at_{i}"))
    apart = F.col("mean") - F.col("common")
    return (
        parts.filter("rows > 0")
        .join(common, same)
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.sum("numbers").alias("numbers"),
            F.first("common", ignorenulls=True).alias("mean"),
            F.sum(F.when(F.col("numbers") > 0, F.col("deviations") + F.col("numbers") * apart * apart)).alias("deviations"),
            F.min("lowest").alias("lowest"),
            F.max("highest").alias("highest"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.when(F.count("sketch") > 0, F.expr("hll_union_agg(sketch, true)")).alias("sketch"),
        )
    )


def _distinct() -> Column:
    """The sketched number of values; NULL is one."""
    some_null = F.when(F.col("nulls") > 0, 1).otherwise(0)
    return F.expr("hll_sketch_estimate(sketch)") + some_null


def profile_of_snapshot(merged: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """The profile that a snapshot stands for, in the columns of ``profile`` with a sketched distinct count."""
    groups = [by] if isinstance(by, str) else list(by)
    variance = F.when(F.col("numbers") > 1, F.col("deviations") / (F.col("numbers") - 1))
    return merged.select(
        *[F.col(quoted(g)) for g in groups],
        "position",
        "column",
        "data_type",
        F.col("rows").alias("total_rows"),
        F.col("nulls").alias("null_count"),
        rate(F.col("nulls"), F.col("rows")).alias("null_rate"),
        F.when(F.col("sketch").isNotNull(), _distinct()).alias("distinct_count"),
        round_to(F.col("lowest"), 2).alias("min"),
        round_to(F.col("highest"), 2).alias("max"),
        round_to(F.col("mean"), 2).alias("mean"),
        round_to(F.sqrt(variance), 2).alias("stddev"),
        "first_day",
        "last_day",
    )


def snapshot_drift(parts: DataFrame, batch: str) -> DataFrame:
    """Every column of every batch beside the batch before: rows, share of NULL, mean, distinct share.

    Reads snapshots only, one row per column and batch. ``shift`` is the change of the mean in standard
    deviations of the batch before.
    """
    levels = {
        "null_rate": rate(F.col("nulls"), F.col("rows")),
        "mean": F.col("mean"),
        "spread": F.sqrt(F.try_divide(F.col("deviations"), F.col("numbers").cast("double"))),
    }
    shown = parts.select(F.col(quoted(batch)), "position", "column", "rows", *[v.alias(k) for k, v in levels.items()])
    order = f"(PARTITION BY column ORDER BY {quoted(batch)})"
    before = shown.withColumns(
        {f"previous_{c}": F.expr(f"lag({c}) OVER {order}") for c in ("rows", "null_rate", "mean", "spread")}
    )
    shift = F.try_divide(F.col("mean") - F.col("previous_mean"), F.col("previous_spread"))
    return before.select(
        F.col(quoted(batch)),
        "column",
        "rows",
        "previous_rows",
        "null_rate",
        "previous_null_rate",
        round_to(F.col("null_rate") - F.col("previous_null_rate"), 4).alias("null_rate_change"),
        round_to(F.col("mean"), 2).alias("mean"),
        round_to(F.col("previous_mean"), 2).alias("previous_mean"),
        round_to(shift, 2).alias("shift"),
    )
