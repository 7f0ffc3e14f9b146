"""Checks kept up to date by file micro-batches, and the parts that streaming runs share.

Each function runs one incremental pass: it takes the files that arrived since
the last pass with the same checkpoint, and ends. A micro-batch is stored under
its epoch and later steps read the stored rows, so a batch that Spark repeats
after a failure overwrites its own files and counts once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import Rule, run_suite
from ..operators.drift import batch_drift, failure_severity
from ..operators.silver import valid_orders
from ..schemas import INGESTED_AT
from ..sources.layers import stamp, write_layer

EPOCH = "epoch"


def read_arrivals(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files arriving in a folder as a stream with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing)


def land(df: DataFrame, landing: str, *, fmt: str = "parquet") -> None:
    """Drop rows into a landing folder as new files."""
    writer = df.write.mode("append").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(landing)


def store_epoch(df: DataFrame, root: str, name: str, epoch: int) -> DataFrame:
    """Store what a micro-batch adds to a table; a repeat replaces it."""
    return write_layer(df, f"{root}/{name}/{EPOCH}={epoch}")


def read_epochs(
    spark: SparkSession, root: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table stored by epoch, with the column ``epoch``."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())]))
    return reader.parquet(f"{root}/{name}").withColumn(EPOCH, F.col(EPOCH).cast("bigint"))


def run_available(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
    """Run ``work`` on everything that has arrived and not been processed."""
    query = (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_checks(
    stream: DataFrame,
    rules: Sequence[Rule],
    root: str,
    *,
    dataset_name: str = "orders",
    by: Sequence[str] = (),
) -> None:
    """Store each micro-batch as bronze and append its check results to ``results``."""

    def work(batch: DataFrame, epoch: int) -> None:
        bronze = store_epoch(stamp(batch, INGESTED_AT), root, "bronze", epoch)
        results = run_suite(bronze, rules, dataset_name=dataset_name, by=by)
        store_epoch(results, root, "results", epoch)

    run_available(stream, f"{root}/checkpoint", work)


def stream_silver_bounded(
    stream: DataFrame,
    root: str,
    *,
    event_time: str,
    delay: str,
    as_of: dt.date | None = None,
    key: str = "order_id",
) -> None:
    """Silver with bounded state: ids are remembered until the watermark passes them.

    For sources whose duplicates arrive close together. Which copy survives is
    up to arrival.
    """
    unique = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

    def work(batch: DataFrame, epoch: int) -> None:
        store_epoch(valid_orders(batch, as_of=as_of), root, "silver", epoch)

    run_available(unique, f"{root}/checkpoint", work)


def drift_alerts(
    spark: SparkSession,
    root: str,
    *,
    first_day: dt.date,
    batch: str = "batch_id",
    severities: Sequence[str] = ("HIGH", "MEDIUM", "LOW"),
    newest_only: bool = False,
) -> DataFrame:
    """Graded failures of the stored batches, of all of them or of the newest.

    Reads the stored results only: one row per rule and batch.
    """
    results = read_epochs(spark, root, "results").drop(EPOCH)
    graded = failure_severity(batch_drift(results, first_day=first_day, batch=batch))
    graded = graded.filter(F.col("severity").isin(*severities))
    if newest_only:
        newest = results.agg(F.max(batch).alias("newest"))  # one row
        graded = graded.join(F.broadcast(newest), F.col(batch) == F.col("newest")).drop("newest")
    return graded
