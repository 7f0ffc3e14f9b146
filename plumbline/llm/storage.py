"""Tables and files in the shared folder that the session names."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import plumbline
from plumbline.session import work_path

BROADCAST_BYTES = 32 << 20

#: Rows that travel to a Python worker at a time, where the session leaves Spark's default of 10,000: with
#: texts of a few kilobytes that fills tens of megabytes on both sides of the pipe, for every task.
BATCH_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark send this package to its Python workers, once per application, and texts in small batches."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(plumbline.__file__).parent
        archive = f"{tempfile.mkdtemp()}/{root.name}"  # the driver serves it from here
        context.addPyFile(shutil.make_archive(archive, "zip", root.parent, root.name))
        _SHIPPED.add(context.applicationId)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_bytes(df: DataFrame) -> int:
    """Bytes of a table's values: eight for a number, the length for text, binary and lists of them."""

    def length(name: str, kind: str):
        if kind in ("string", "binary"):
            return F.octet_length(name)
        if kind == "array<binary>":
            return F.aggregate(name, F.lit(0), lambda total, x: total + F.octet_length(x))
        return F.size(name) * 8 if kind.startswith("array") else F.lit(8)

    parts = [F.coalesce(length(name, kind), F.lit(0)) for name, kind in df.dtypes]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return df.agg(F.sum(total.cast("long"))).first()[0] or 0


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The side of a join, marked for broadcasting if its measured bytes are within the limit.

    Above it the mark is left out and the join shuffles both sides.
    """
    return F.broadcast(df) if table_bytes(df) <= limit else df
