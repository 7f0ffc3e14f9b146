"""Schemas of batches over time: stored snapshots, and what changed with which batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import struct_of
from ..sources.layers import write_layer

SNAPSHOT = struct_of(
    batch=T.LongType(), rows=T.LongType(), position=T.IntegerType(), column=T.StringType(), data_type=T.StringType()
)
APPEARED, VANISHED, RETYPED, MOVED = "appeared", "vanished", "retyped", "moved"


def schema_snapshot(df: DataFrame, batch: int) -> DataFrame:
    """One row per column of a batch, nested types spelled out, with the batch's rows.

    A batch without columns has one row without a column name, so that it is a batch all the same.
    """
    rows = df.count()
    fields = [(batch, rows, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields or [(batch, rows, None, None, None)], SNAPSHOT)


def write_schema_snapshot(df: DataFrame, batch: int, root: str) -> None:
    """Store a batch's schema under its number; a batch read again replaces its own."""
    write_layer(schema_snapshot(df, batch).drop("batch"), f"{root}/batch={batch}")


def read_schema_snapshots(spark: SparkSession, root: str) -> DataFrame:
    others = [f for f in SNAPSHOT.fields if f.name != "batch"]
    return spark.read.schema(T.StructType([*others, SNAPSHOT["batch"]])).parquet(root)


def schema_changes(snapshots: DataFrame) -> DataFrame:
    """Every change of a column against the batch before: what changed, from which type to which, in which version.

    ``appeared``, ``vanished``, ``retyped``, or ``moved`` to another place among the columns that both batches have. A
    version is a run of batches with the same schema; versions count from 1. The first batch
    changes nothing. Reads one row per column and batch, no data.
    """
    batches = snapshots.groupBy("batch").agg(F.max("rows").alias("rows"))
    after = batches.select("batch", F.lead("batch").over(W.orderBy("batch")).alias("next")).filter("next IS NOT NULL")
    named = snapshots.filter(F.col("column").isNotNull()).select("batch", "position", "column", "data_type")
    before = named.join(after, "batch").select(
        F.col("next").alias("batch"), "column", F.col("position").alias("old_position"), F.col("data_type").alias("old_type")
    )
    later = after.select(F.col("next").alias("batch"))
    pairs = named.join(later, "batch", "left_semi").join(before, ["batch", "column"], "full")
    # Places among the columns of both, so that a new column moves none behind it.
    common = W.partitionBy("batch", F.col("position").isNotNull() & F.col("old_position").isNotNull())
    placed = pairs.withColumns(
        {"place": F.rank().over(common.orderBy("position")), "old_place": F.rank().over(common.orderBy("old_position"))}
    )
    change = (
        F.when(F.col("old_type").isNull(), APPEARED)
        .when(F.col("data_type").isNull(), VANISHED)
        .when(F.col("data_type") != F.col("old_type"), RETYPED)
        .when(F.col("place") != F.col("old_place"), MOVED)
    )
    changed = placed.withColumn("change", change).filter(F.col("change").isNotNull())
    versions = batches.join(
        changed.select(F.col("batch").alias("at")).distinct(), F.col("batch") == F.col("at"), "left"
    ).select("batch", "rows", (F.count("at").over(W.orderBy("batch")) + 1).alias("version"))
    return changed.join(versions, "batch").select(
        "batch", "version", "rows", "column", "change", F.col("old_type").alias("from_type"), F.col("data_type").alias("to_type")
    )
