"""Exact deduplication by sorting whole contents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import shuffle_partitions

SAMPLES_PER_PARTITION = 200
HOT_SAMPLES = 50
SEED = 17
HEAD_CHARS = 24


def _hot_texts(rows: DataFrame, partitions: int) -> DataFrame | None:
    """Digests of texts that fill a fair part of a partition, and into how many parts to cut them.

    They come from a sample of bounded size; a text that the sample misses only
    makes a partition fuller, never a result wrong.
    """
    total = rows.count()
    wanted = SAMPLES_PER_PARTITION * partitions
    fraction = min(1.0, wanted / max(total, 1))
    found = (
        rows.sample(fraction, SEED)
        .groupBy(F.sha2("text", 256).alias("hot_sha256"))
        .agg(F.count("*").alias("seen"))
        .filter(F.col("seen") >= HOT_SAMPLES)
        .collect()  # at most wanted / HOT_SAMPLES rows
    )
    if not found:
        return None
    share = fraction * max(total, 1)
    parts = [(r.hot_sha256, max(2, -(-2 * partitions * r.seen // max(1, int(share))))) for r in found]
    return rows.sparkSession.createDataFrame(parts, "hot_sha256 string, parts int")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per input row: its id, the id that stays of its group of equal texts, the group's size.

    Rows are range-partitioned by their (normalised) bytes between splitters that
    Spark samples, and sorted; equal texts are then neighbours and compared in full
    by the window over the text. So that splitters stay short, the bytes are
    ordered by their first characters, a hash of all of them, and then all of them.
    A text that the sample shows to be very frequent is cut into salted parts,
    each a range of its own, whose results are put together by the full text again.

    A null text counts as empty. ``keep`` is "min" or "max"; of repeated rows with
    that id one stays. Null ids count in the size, and stay only where a group
    has no other id. Other columns of ``docs`` are not read. An empty table gives
    an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (normalise(text) if normalise else text).alias("text")
    )
    pick = {"min": F.min, "max": F.max}[keep]
    order = F.asc_nulls_last("doc_id") if keep == "min" else F.desc_nulls_last("doc_id")
    hot = _hot_texts(rows, shuffle_partitions(docs.sparkSession))
    rows = rows.select(
        "*",
        F.sha2("text", 256).alias("text_sha256"),
        F.left("text", F.lit(HEAD_CHARS)).alias("head"),
        F.xxhash64("text").alias("mark"),
    )
    if hot is not None:
        rows = rows.join(F.broadcast(hot), rows.text_sha256 == hot.hot_sha256, "left").drop("hot_sha256")
        salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int")
        rows = rows.withColumn("salt", salt)
    ranges = ["head", "mark"] if hot is None else ["head", "mark", "salt"]
    equal = Window.partitionBy(*ranges, "text")
    groups = rows.repartitionByRange(*ranges).select(
        "*",
        F.row_number().over(equal.orderBy(order)).alias("place"),
        pick("doc_id").over(equal).alias("keep_id"),
        F.count("*").over(equal).alias("group_size"),
    )
    if hot is not None:
        whole = (
            rows.filter(F.col("parts").isNotNull())
            .groupBy(F.col("text").alias("hot_text"))
            .agg(pick("doc_id").alias("hot_keep_id"), F.count("*").alias("hot_size"))
        )
        # No more rows than the hot digests above.
        groups = groups.join(
            F.broadcast(whole),
            F.when(F.col("parts").isNotNull(), F.col("text")) == F.col("hot_text"),
            "left",
        ).withColumns(
            {
                "keep_id": F.when(F.col("hot_size").isNull(), F.col("keep_id")).otherwise(F.col("hot_keep_id")),
                "group_size": F.coalesce("hot_size", "group_size"),
            }
        )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)
    return groups.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
