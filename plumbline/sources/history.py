"""The check history as a stored table, partitioned by dataset and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import HISTORY

PARTS = ["dataset_name", "batch"]
_STORED = T.StructType([f for f in HISTORY.fields if f.name not in PARTS] + [HISTORY[p] for p in PARTS])


def write_history(history: DataFrame, path: str) -> None:
    """Add batches to the history; a batch of a dataset checked again replaces its rows, and no others."""
    writer = history.select(*[f.name for f in _STORED.fields]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history; filters on dataset and batch read those folders only."""
    return spark.read.schema(_STORED).parquet(path).select(*[f.name for f in HISTORY.fields])
