"""Raw CSV files, stored layers, audit stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INGESTED_AT, ORDERS

CORRUPT = "_corrupt_record"


def read_orders_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = ORDERS,
    enforce_header: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Raw order files with a header line and the declared schema.

    Unreadable and missing cells become NULL, extra cells are dropped. Columns
    are taken by position unless ``enforce_header`` compares the names too;
    ``keep_corrupt`` keeps the text of every malformed line.
    """
    reader = spark.read.option("header", True).option("enforceSchema", not enforce_header)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header line; NULL is written as an empty cell."""
    df.write.mode("overwrite").option("header", True).csv(path)


def stamp(df: DataFrame, column: str = INGESTED_AT) -> DataFrame:
    """Add the time of this run as an audit column."""
    return df.withColumn(column, F.current_timestamp())


def write_layer(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """Store a layer and go on from the stored files.

    Later steps read what was written, so they neither recompute the plan nor
    see other rows than the stored ones, and a lost executor costs only a
    re-read. The schema is known, so reading back starts no job to infer it.
    """
    df.write.mode(mode).format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)
