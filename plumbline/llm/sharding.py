"""Sharding by ranges of a content key with nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import shuffle_partitions, stored

SAMPLES_PER_RANGE = 64
ROUNDS = 4
OVERFULL = 2.0
WHOLE_PART = 16  # a group of up to a sixteenth of a shard stays in one shard
ID_OFFSET = "CAST(9223372036854775808 AS DECIMAL(20, 0))"


def _key() -> Column:
    """Content digest and id as one text that sorts like the pair."""
    number = F.expr(f"CAST(CAST(doc_id AS DECIMAL(20, 0)) + {ID_OFFSET} AS DECIMAL(20, 0))")
    return F.concat("digest", F.coalesce(F.lpad(number.cast("string"), 20, "0"), F.lit("")))


def _range_of(key: Column, splitters: list[str]) -> Column:
    """How many of the sorted splitters are not above the key, by halving."""
    if not splitters:
        return F.lit(0)
    all_of = F.split(F.lit(",".join(splitters)), ",")
    steps = [1 << b for b in reversed(range(len(splitters).bit_length()))]

    def halve(low: Column, step: Column) -> Column:
        at = F.get(all_of, low + step - 1)
        return F.when(F.coalesce(at <= key, F.lit(False)), low + step).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def _sample(rows: DataFrame, weight: Column, total: float, wanted: int) -> list[str]:
    """Keys drawn with chances in proportion to their weight, the same in every run."""
    chance = weight * F.lit(wanted / max(total, 1.0))
    drawn = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Bounded: about `wanted` keys whatever the table's size.
    return sorted(r.key for r in rows.filter(drawn < chance).select("key").collect())


def _quantiles(keys: list[str], pieces: int) -> list[str]:
    """Boundaries that cut sorted keys into pieces; a group is cut inside only if it fills pieces."""
    picked = [keys[i * len(keys) // pieces] for i in range(1, pieces)] if keys else []
    digests = [k[:64] for k in picked]
    frequent = {a for a, b in zip(digests, digests[1:]) if a == b}
    return sorted({k if k[:64] in frequent else k[:64] for k in picked})


def shard(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Put documents into shards of nearly equal bytes; equal texts stay together.

    Documents are ordered by (SHA-256 of the text, id) and cut at equal shares of
    all bytes, a document's size being its UTF-8 bytes plus one. A group of equal
    texts goes whole to the shard where its middle lies, unless it has more than a
    sixteenth of a shard's bytes; then each of its rows goes where its own middle
    lies. ``slot`` counts a shard's documents from 0 in that order.

    The order is computed range by range: keys drawn in proportion to weight give
    splitters at their quantiles, ranges that turn out overfull are sampled
    again and subdivided (within one text by id), and sums over ranges give each
    range its start. The result does not depend on the sample.

    A null text is empty. Null ids sort first. Rows repeated with id and text sit
    side by side in any order. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        ),
        "shard-sizes",
    )
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    mean = max(1, total // max(1, count))
    keyed = rows.withColumn("key", _key())
    weight = F.col("size") + F.lit(mean)  # of a task: its bytes and its rows
    pieces = shuffle_partitions(spark)
    load = total + mean * count
    splitters = _quantiles(_sample(keyed, weight, load, SAMPLES_PER_RANGE * pieces), pieces)

    def measured() -> tuple[DataFrame, list]:
        ranged = keyed.withColumn("range", _range_of(F.col("key"), splitters))
        sums = ranged.groupBy("range").agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.sum(weight).alias("load")
        )
        return ranged, sorted(sums.collect())  # one row per range

    ranged, sums = measured()
    for _ in range(ROUNDS):
        fair = OVERFULL * load / pieces
        overfull = [r for r in sums if r.load > fair]
        more = set(splitters)
        for r in overfull:
            parts = int(2 * r.load / fair) + 1
            inside = _sample(ranged.filter(F.col("range") == r.range), weight, r.load, SAMPLES_PER_RANGE * parts)
            more |= set(_quantiles(inside, parts))
        if len(more) == len(splitters):
            break
        splitters = sorted(more)
        ranged, sums = measured()

    starts, rows_before, bytes_before = [], 0, 0
    for r in sums:
        starts.append((r.range, rows_before, bytes_before))
        rows_before, bytes_before = rows_before + r.rows, bytes_before + r.bytes
    bases = spark.createDataFrame(starts, "range int, rows_before long, bytes_before long")
    cut = _cut_groups(spark, ranged, splitters, {r: b for r, _, b in starts})

    in_range = Window.partitionBy("range").orderBy("digest", F.asc_nulls_first("doc_id"))
    running = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("range", "digest")
    line = (
        ranged.drop("key")
        .repartition("range")
        .withColumn("rank", F.row_number().over(in_range) - 1)
        .withColumn("before", F.sum("size").over(running) - F.col("size"))
        .withColumn("group_before", F.min("before").over(group))
        .withColumn("group_bytes", F.sum("size").over(group))
        .join(F.broadcast(bases), "range")  # one row per range
        .join(F.broadcast(cut), "digest", "left")  # no more rows than splitters
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rank") + F.col("rows_before")).alias("rank"),
            (F.col("before") + F.col("bytes_before")).alias("before"),
            F.coalesce("cut_start", F.col("group_before") + F.col("bytes_before")).alias("group_start"),
            F.coalesce("cut_bytes", "group_bytes").alias("group_bytes"),
        )
    )
    whole = F.col("group_bytes") * (WHOLE_PART * shards) <= F.lit(total)
    twice = F.when(whole, 2 * F.col("group_start") + F.col("group_bytes")).otherwise(
        2 * F.col("before") + F.col("size")
    )
    exact = F.floor(twice.cast("decimal(38, 0)") * shards / F.lit(max(1, 2 * total)).cast("decimal(20, 0)"))
    placed = stored(line.withColumn("shard", exact.cast("int")), "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # one row per shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _cut_groups(spark, ranged: DataFrame, splitters: list[str], bases: dict[int, int]) -> DataFrame:
    """Start and bytes of the groups that a splitter cuts inside: at most one per splitter."""
    first_range: dict[str, int] = {}
    for i, s in enumerate(splitters):
        if len(s) > 64:
            first_range.setdefault(s[:64], i)
    schema = "digest string, cut_start long, cut_bytes long"
    if not first_range:
        return spark.createDataFrame([], schema)
    where = spark.createDataFrame(
        [(d, i) for d, i in first_range.items()], "cut_digest string, cut_range int"
    )
    bytes_of = dict(
        ranged.join(F.broadcast(where), F.col("digest") == F.col("cut_digest"))
        .groupBy("digest")
        .agg(F.sum("size"))
        .collect()
    )
    smaller = dict(
        ranged.join(F.broadcast(where), F.col("range") == F.col("cut_range"))
        .filter(F.col("digest") < F.col("cut_digest"))
        .groupBy("cut_digest")
        .agg(F.sum("size"))
        .collect()
    )

    def start(digest: str, i: int) -> int:
        # The range may be empty; the next one that has rows then starts with the group.
        base = min((b for r, b in bases.items() if r >= i), default=0)
        return base + (smaller.get(digest) or 0)

    found = [(d, start(d, i), bytes_of[d]) for d, i in first_range.items() if d in bytes_of]
    return spark.createDataFrame(found, schema)
