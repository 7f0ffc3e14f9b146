"""One streaming run that keeps layers, checks, history and alerts together, epoch by epoch.

A micro-batch is an epoch. Its tables are written one by one and become visible
together, by a manifest row written last. Ids seen before live in Spark's keyed
state (RocksDB), so an epoch costs what its own rows cost, however much came before.
"""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import named
from ..operators.checks import Rule, run_suite
from ..operators.drift import batch_drift, failure_severity
from ..operators.gold import merge_daily_orders, merge_revenue_by_category, revenue_parts
from ..operators.monitor import to_history
from ..operators.silver import ACCEPTED, VERDICT, accepted, deduplicate_orders, judge_orders, rejected, write_verdicts
from ..operators.snapshots import snapshot
from ..schemas import INGESTED_AT, TRANSFORMED_AT, struct_of
from ..sources.layers import stamp, write_layer
from .micro_batches import EPOCH, read_arrivals, read_epochs, store_epoch

GOLD_KEYS = ("product_category", "order_date")
MANIFEST = "manifest"
_MANIFEST = struct_of(files=T.LongType(), bronze_rows=T.LongType(), silver_rows=T.LongType())
_UNIQUENESS = struct_of(
    column=T.StringType(),
    rows=T.LongType(),
    new_keys=T.LongType(),
    all_rows=T.LongType(),
    all_keys=T.LongType(),
    success=T.BooleanType(),
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
_KEYS_SENT = 32 << 20  # bytes of repeated keys that an epoch sends to every executor at most
_KEY_BYTES = 48  # of a key in memory, beside its own bytes


@dataclass(frozen=True)
class Landing:
    """A folder in which immutable files arrive."""

    path: str
    schema: T.StructType
    fmt: str = "parquet"
    files_per_batch: int | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        return read_arrivals(spark, self.path, self.schema, fmt=self.fmt, files_per_batch=self.files_per_batch)

    def rows_of(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """The rows of files named by ``_metadata.file_path``, which escapes as an address does."""
        files = [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(file)) for file in files]
        reader = spark.read.format(self.fmt).schema(self.schema).option("basePath", self.path)
        if self.fmt == "csv":
            reader = reader.option("header", True)
        return reader.load(files)


@dataclass(frozen=True)
class Keep:
    """What a run keeps per epoch: layers always, checks and alerts where rules are given, snapshots if profiled.

    ``batch`` names the column whose values are the batches that checks are reported and
    compared by; without one an epoch is a batch. A batch arrives in one epoch.
    """

    rules: Sequence[Rule] = ()
    key: str = "order_id"
    as_of: dt.date | None = None
    dataset_name: str = "orders"
    batch: str | None = None
    first_day: dt.date = dt.date(1970, 1, 1)
    severities: Sequence[str] = ("HIGH", "MEDIUM", "LOW")
    profiled: bool = False

    @property
    def batch_column(self) -> str:
        return self.batch or EPOCH


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, unless the session names a provider itself.

    Unless the session says so, RocksDB does not count its rows, for which it would look up every key a
    second time; the epochs count the keys themselves. Every partition of the state writes files of its own in
    every epoch. A count per key takes far less room than rows, so the state gets a quarter of the session's
    partitions, but one for each core; a run that goes on keeps the number it began with.
    """
    partitions = int(spark.conf.get(_PARTITIONS))
    cores = spark.sparkContext.defaultParallelism
    provider = spark.conf.get(_PROVIDER, None)
    before = {}
    if provider is None or provider.endswith("HDFSBackedStateStoreProvider"):
        before[_PROVIDER] = provider
        spark.conf.set(_PROVIDER, _ROCKSDB)
    if spark.conf.get(_COUNTED, None) is None:
        before[_COUNTED] = None
        spark.conf.set(_COUNTED, "false")
    before[_PARTITIONS] = spark.conf.get(_PARTITIONS, None)
    spark.conf.set(_PARTITIONS, str(max(partitions // 4, min(partitions, cores))))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _touched(stream: DataFrame, key: str) -> DataFrame:
    """How often every key came up to now, for the keys of a micro-batch, and the micro-batch's files.

    The state is one count per key. Rows are counted per task before the shuffle, so a key
    that a third of all rows share is one row per task.
    """
    kind = stream.schema[key].dataType

    def row(is_file: bool, value: Column, file: Column) -> Column:
        return F.struct(F.lit(is_file).alias("is_file"), value.alias("key"), file.alias("file"))

    of_key = row(False, named(key), F.lit(None).cast("string"))
    of_file = row(True, F.lit(None).cast(kind), F.col("_metadata.file_path"))
    return stream.select(F.inline(F.array(of_key, of_file))).groupBy("is_file", "key", "file").agg(F.count("*").alias("times"))


def _few(touched: DataFrame) -> bool:
    """Whether the keys that came more than once are few enough to be sent to every executor."""
    size = F.sum(F.coalesce(F.octet_length(F.col("key").cast("string")), F.lit(0)) + _KEY_BYTES)
    return (touched.filter(~F.col("is_file") & (F.col("times") > 1)).agg(size).first()[0] or 0) <= _KEYS_SENT


def _new_rows(bronze: DataFrame, touched: DataFrame, key: str, nameless: int = 0, few: bool = False) -> DataFrame:
    """The surviving row of every key that no earlier epoch held; NULL is a key, met ``nameless`` times up to now.

    A key that came once up to now is new and has one row. If the others are ``few``, they are sent to every executor:
    rows of keys that came once stay where they lie, and only rows of the others are dealt and sorted.
    A key is old if it came more often up to now than in this epoch, so only keys that came more than once are
    compared; they are joined with the rows of the epoch, which are sorted by key as they are, to leave old ones out.
    Rows and counts are each dealt once by the key itself and joined where they lie; a null-safe join, or one on the
    counts too, would deal them again. So NULL, which equals nothing, is looked at apart where it came.
    """
    ever = touched.filter(~F.col("is_file") & (F.col("times") > 1)).select(F.col("key").alias("ever"), "times")
    keyed, once = bronze.filter(named(key).isNotNull()), None
    if few:
        again, same = F.broadcast(ever.select(F.col("ever").alias("again"))), named(key) == F.col("again")
        keyed, once = keyed.join(again, same, "left_semi"), keyed.join(again, same, "left_anti")
    here = keyed.groupBy(named(key).alias("here")).agg(F.count("*").alias("rows"))
    old = here.join(ever, (F.col("here") == F.col("ever")) & (F.col("rows") < F.col("times"))).select("here")
    rows = deduplicate_orders(keyed, key=key).join(old, named(key) == F.col("here"), "left_anti")
    if once is not None:
        rows = once.unionByName(rows)
    nulls = bronze.filter(named(key).isNull())
    if nameless and nulls.count() == nameless:
        rows = rows.unionByName(deduplicate_orders(nulls, key=key))
    return rows


def _alerts(spark: SparkSession, root: str, results: DataFrame, epoch: int, keep: Keep) -> DataFrame:
    """Graded failures of this epoch's batches, each compared with the batch before it.

    Reads the results of this epoch and of the one before, nothing older.
    """
    compared = results.withColumn(EPOCH, F.lit(epoch).cast("long"))
    if epoch > 0:
        last = spark.read.schema(results.schema).parquet(f"{root}/results/{EPOCH}={epoch - 1}")
        compared = compared.unionByName(last.withColumn(EPOCH, F.lit(epoch - 1).cast("long")))
    graded = failure_severity(batch_drift(compared, first_day=keep.first_day, batch=keep.batch_column))
    return graded.filter((F.col(EPOCH) == epoch) & F.col("severity").isin(*keep.severities)).drop(EPOCH)


def store_verdicts(judged: DataFrame, root: str, epoch: int) -> DataFrame:
    """Store the new rows of an epoch by verdict; a repeat replaces them."""
    return write_verdicts(judged, f"{root}/judged/{EPOCH}={epoch}")


def _uniqueness(spark: SparkSession, root: str, rows: int, new: int, epoch: int, keep: Keep) -> tuple:
    """Rows and distinct keys of the epoch, and of all epochs up to it.

    A key is counted where it is new, so the totals are those of the epoch before plus what is
    new here: the uniqueness check over all history, from one row of it.
    """
    all_rows, all_keys = rows, new
    if epoch > 0:
        before = spark.read.schema(_UNIQUENESS).parquet(f"{root}/uniqueness/{EPOCH}={epoch - 1}").first()
        all_rows, all_keys = before["all_rows"] + rows, before["all_keys"] + new
    return keep.key, rows, new, all_rows, all_keys, all_rows == all_keys


def _store(spark: SparkSession, landing: Landing, root: str, touched: DataFrame, epoch: int, keep: Keep) -> int:
    """All tables of an epoch, and the manifest row that shows them; the number of keys up to it."""
    # Read more than once below; a repeated epoch finds the same state and replaces it. A key that came once is not looked at.
    looked_at = F.col("is_file") | F.col("key").isNull() | (F.col("times") > 1)
    touched.filter(looked_at).write.mode("overwrite").parquet(f"{root}/touched")
    touched = spark.read.schema(touched.schema).parquet(f"{root}/touched")
    told = touched.filter("is_file OR key IS NULL").collect()  # the files that one micro-batch takes, and at most one key
    files = [row["file"] for row in told if row["is_file"]]
    nameless = sum(row["times"] for row in told if not row["is_file"])
    bronze = store_epoch(stamp(landing.rows_of(spark, files), INGESTED_AT), root, "bronze", epoch)
    judged = judge_orders(_new_rows(bronze, touched, keep.key, nameless, _few(touched)), as_of=keep.as_of)
    judged = store_verdicts(judged, root, epoch)
    # At most one row per category and day; both gold tables merge these.
    store_epoch(revenue_parts(accepted(judged), *GOLD_KEYS), root, "gold", epoch)
    rows, by_verdict = bronze.count(), dict(judged.groupBy(VERDICT).count().collect())
    new = sum(by_verdict.values())
    unique = _uniqueness(spark, root, rows, new, epoch, keep)
    store_epoch(spark.createDataFrame([unique], _UNIQUENESS), root, "uniqueness", epoch)
    if keep.profiled:
        store_epoch(snapshot(bronze), root, "snapshots", epoch)
    if keep.rules:
        by = [keep.batch] if keep.batch else []
        results = run_suite(bronze, keep.rules, dataset_name=keep.dataset_name, by=by)
        results = store_epoch(results, root, "results", epoch)
        numbered = results if keep.batch else results.withColumn(EPOCH, F.lit(epoch))
        store_epoch(to_history(numbered, batch=keep.batch_column), root, "history", epoch)
        store_epoch(_alerts(spark, root, results, epoch, keep), root, "alerts", epoch)
    counts = [(len(files), rows, by_verdict.get(ACCEPTED, 0))]
    store_epoch(spark.createDataFrame(counts, _MANIFEST), root, MANIFEST, epoch)
    return unique[4]


def start_run(spark: SparkSession, landing: Landing, root: str, keep: Keep = Keep(), *, every: str | None = None) -> StreamingQuery:
    """Keep layers, check results, history and alerts below ``root`` up to date with the arriving files.

    Per epoch: ``bronze`` (the rows with their time of arrival), ``judged`` (of the rows whose key is
    new, whether an earlier copy was valid or not, the valid ones and, apart, the rejected ones with their
    reasons), ``gold`` (mergeable parts), ``uniqueness`` (of the key over all history), if profiled
    ``snapshots`` (a mergeable profile), and with rules ``results``, ``history`` and ``alerts``. ``manifest``
    gets a row when all of them are written; readers (``committed``) show an epoch only then.
    An epoch that broke off is repeated from the same files and the same state, and replaces what it
    had written.

    Whether a key is new is read from the query's own keyed state, which holds one count per key
    in RocksDB and is looked up for the keys of the epoch only. No table of an earlier epoch is
    read, but for the results and the totals just before. ``every`` (``"1 minute"``) keeps the query
    running with that trigger; without it the query takes what has arrived and ends.
    """
    return _start(spark, landing, root, keep, every)[0]


def _start(spark: SparkSession, landing: Landing, root: str, keep: Keep, every: str | None = None) -> tuple[StreamingQuery, dict[int, int]]:
    """The started query, and the number of keys up to every epoch that it has stored."""
    write_layer(spark.createDataFrame([], _MANIFEST), f"{root}/{MANIFEST}/{EPOCH}=-1", mode="ignore")

    keys: dict[int, int] = {}

    def work(touched: DataFrame, epoch: int) -> None:
        # The session given, not the stream's own: adaptive execution is off in that one.
        keys[epoch] = _store(spark, landing, root, touched, epoch, keep)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = _touched(landing.stream(spark), keep.key).writeStream.outputMode("update").foreachBatch(work)
    with _rocksdb(spark):
        return writer.option("checkpointLocation", f"{root}/checkpoint").trigger(**trigger).start(), keys


def run_available(spark: SparkSession, landing: Landing, root: str, keep: Keep = Keep()) -> list[dict]:
    """One pass over what has arrived and not been processed; the progress of its epochs."""
    query, keys = _start(spark, landing, root, keep)
    query.awaitTermination()
    return _progress(query, keys)


def _progress(query: StreamingQuery, keys: dict[int, int]) -> list[dict]:
    """Rows, milliseconds and keyed state (a row per key) of every epoch that Spark still reports."""
    out = []
    for p in query.recentProgress:
        if p["numInputRows"]:
            state = p["stateOperators"][0] if p["stateOperators"] else {}
            more = state.get("customMetrics", {})
            out.append(
                {
                    EPOCH: p["batchId"],
                    "input_rows": p["numInputRows"],
                    "milliseconds": p["durationMs"].get("triggerExecution", 0),
                    "state_rows": keys.get(p["batchId"], 0),
                    "state_rows_updated": state.get("numRowsUpdated", 0),
                    "state_lookups": more.get("rocksdbGetCount", 0),
                }
            )
    return out


def run_for(
    spark: SparkSession,
    landing: Landing,
    root: str,
    keep: Keep = Keep(),
    *,
    every: str = "0 seconds",
    epochs: int | None = None,
    idle_seconds: float | None = None,
    seconds: float | None = None,
) -> list[dict]:
    """A running trigger with a stop rule: after so many epochs, so long without new files, or so long at all.

    Returns the progress of its epochs. A query that fails raises its error here. An
    epoch that the stop cuts off is not in the manifest and is repeated by the next run.
    """
    if epochs is None and idle_seconds is None and seconds is None:
        raise ValueError("give a stop rule: epochs, idle_seconds or seconds")
    query, keys = _start(spark, landing, root, keep, every)
    began = moved = time.monotonic()
    seen: dict[int, dict] = {}
    try:
        while query.isActive:
            before = len(seen)
            seen |= {p[EPOCH]: p for p in _progress(query, keys)}
            now = time.monotonic()
            if len(seen) > before or query.status["isTriggerActive"] and query.status["isDataAvailable"]:
                moved = now
            if epochs is not None and len(seen) >= epochs:
                break
            if idle_seconds is not None and now - moved >= idle_seconds:
                break
            if seconds is not None and now - began >= seconds:
                break
            time.sleep(0.1)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    seen |= {p[EPOCH]: p for p in _progress(query, keys)}
    return [seen[e] for e in sorted(seen)]


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per epoch that is whole: files, bronze_rows, silver_rows, epoch."""
    return read_epochs(spark, root, MANIFEST, _MANIFEST)


def committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of all epochs that are whole, with the column ``epoch``."""
    rows = read_epochs(spark, root, name)
    whole = manifest(spark, root).select(F.col(EPOCH).alias("whole"))  # one row per epoch
    return rows.join(F.broadcast(whole), F.col(EPOCH) == F.col("whole"), "left_semi")


def stored_silver(spark: SparkSession, root: str) -> DataFrame:
    return accepted(_judged(spark, root)).drop(INGESTED_AT, TRANSFORMED_AT)


def stored_rejects(spark: SparkSession, root: str) -> DataFrame:
    return rejected(_judged(spark, root)).drop(INGESTED_AT, TRANSFORMED_AT)


def _judged(spark: SparkSession, root: str) -> DataFrame:
    return committed(spark, root, "judged").withColumn(VERDICT, F.col(VERDICT).cast("string"))


def stored_revenue_by_category(spark: SparkSession, root: str) -> DataFrame:
    return merge_revenue_by_category(committed(spark, root, "gold"))


def stored_daily_orders(spark: SparkSession, root: str) -> DataFrame:
    return merge_daily_orders(committed(spark, root, "gold"))
