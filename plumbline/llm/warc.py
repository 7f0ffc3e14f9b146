"""A content-addressed web archive: payloads once in WARC files, exact record headers beside them."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import urllib.parse
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import work_path

from .storage import ship_package, small_side, stored
from .token_files import open_folder

PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
INDEX = "file string, offset long, length long, page_id long, digest string, header binary"
RECORD = (
    "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "header binary, payload binary"
)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _header(row: dict, digest: str, length: int, date: str) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_record_id(row['page_id'], row['url'])}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {urllib.parse.quote(row['url'], safe=PRINTABLE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_record_id(row['refers_to'], row['refers_url'])}")
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page: {row['refers_to']}")
    if row["page_id"] is not None:
        lines.append(f"X-Page: {row['page_id']}")
    lines += ["Content-Type: text/html", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def _writer(folder: str, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        from pyspark import TaskContext

        files, base = open_folder(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            index = []
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                payload = row["payload"] or b""
                if row["record_type"] == "response":
                    digest = base32_digest(payload)
                    if hashlib.sha256(payload).hexdigest() != row["sha256"]:
                        raise ValueError(f"payload of page {row['page_id']} differs from its digest")
                else:
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                header = _header(row, digest, len(payload), date)
                member = gzip.compress(header + payload + b"\r\n\r\n", 4, mtime=0)
                out = out or files.open_output_stream(f"{base}/warc/{name}", compression=None)
                out.write(member)
                index.append((name, at, len(member), row["page_id"], digest, header))
                at += len(member)
            columns = zip(*index) if index else [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ("file", "offset", "length", "page_id", "digest", "header")
            yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})
        if out is not None:
            out.close()

    return run


def write_archive(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write a WARC record for each page; equal payloads are stored once.

    Of pages with equal payloads (by SHA-256 of their UTF-8 bytes) of at least
    ``min_bytes`` the one with the largest id becomes a response that holds the
    payload; the others become revisits without it. Smaller payloads are all
    responses. ``folder/warc`` holds gzipped WARC 1.1 files, one member a record;
    ``folder/headers`` is a table of every record's exact header, its payload
    digest and where it lies. Spark commits that table, and only files it names count.

    Only ids and digests are compared: a payload crosses the network once, after
    equal ones in a task are merged, so a payload held by a third of all pages is
    no hot spot. A null payload is empty, a null url is an empty one. Null ids are the smallest.
    Rows repeated in id, url and payload: one of them may be the response, the
    others revisit it. Other columns are not read.
    """
    ship_package(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.sha2(payload, 256).alias("sha256"),
        payload.alias("payload"),
    )
    slim = read.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"))
    alone = F.when(F.col("size") < min_bytes, F.struct("page_id", "url"))
    records = stored(
        slim.groupBy("page_id", "url", "sha256", "sha1", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("key", F.concat_ws(" ", "sha256", alone["page_id"].cast("string"), alone["url"])),
        "warc-records",
    )
    chosen = stored(
        records.groupBy("key").agg(F.max(F.struct("page_id", "url")).alias("of")).select(
            F.col("key").alias("chosen_key"), F.col("of.page_id").alias("refers_to"), F.col("of.url").alias("refers_url")
        ),
        "warc-responses",
    )
    placed = records.join(small_side(chosen), records.key == F.col("chosen_key"))
    first = F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("url") == F.col("refers_url"))
    # A response stands for one of its copies, unless every copy of a small payload is a response.
    responses = placed.filter(first).select(
        "page_id", "url", "sha256", F.when(F.col("size") < min_bytes, F.col("copies")).otherwise(1).alias("times")
    )
    revisits = placed.withColumn("times", F.col("copies") - F.when(first, 1).otherwise(0)).filter(
        (F.col("times") > 0) & (F.col("size") >= min_bytes)
    )
    payloads = read.select("sha256", "payload").dropDuplicates(["sha256"])
    full = responses.join(payloads, "sha256").select(
        "page_id", "url", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
        F.lit(None).cast("string").alias("refers_url"), "sha256", F.lit(None).cast("string").alias("sha1"), "payload", "times",
    )
    short = revisits.select(
        "page_id", "url", F.lit("revisit").alias("record_type"), "refers_to", "refers_url", "sha256", "sha1",
        F.lit(None).cast("binary").alias("payload"), "times",
    )
    rows = full.unionByName(short)
    rows = rows.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("time", "times")
    files, base = open_folder(folder)
    files.create_dir(f"{base}/warc", recursive=True)
    rows.mapInArrow(_writer(folder, date), INDEX).write.parquet(f"{folder}/headers")


def _field(header: dict[str, str], name: str) -> int | None:
    return int(header[name]) if name in header else None


def parse_records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an unpacked WARC stream, payloads checked against their digests."""
    while line := stream.readline():
        if not line.strip():
            continue
        raw, header = [line], {}
        while (line := stream.readline()).strip():
            raw.append(line)
            name, _, value = line.decode().partition(":")
            header[name] = value.strip()
        raw.append(line)
        payload = stream.read(int(header["Content-Length"]))
        digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
        response = header["WARC-Type"] == "response"
        if response and base32_digest(payload) != digest:
            raise ValueError(f"payload differs from its digest {digest}")
        yield {
            "page_id": _field(header, "X-Page"),
            "record_type": header["WARC-Type"],
            "payload_digest": digest,
            "payload_bytes": len(payload) if response else None,
            "refers_to": _field(header, "X-Refers-To-Page"),
            "header": b"".join(raw),
            "payload": payload if response else None,
        }


def _reader(folder: str, payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("header", pa.binary()), ("payload", pa.binary()),
        ]
    )

    def run(batches):
        files, base = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_file(f"{base}/warc/{name}") as f, gzip.GzipFile(fileobj=f) as stream:
                    held = []
                    for record in parse_records(io.BufferedReader(stream)):
                        held.append(record if payloads else record | {"payload": None})
                        if len(held) == 256:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_archive(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the archive's files, as stored; payloads of responses on request."""
    ship_package(spark)
    names = spark.read.schema(INDEX).parquet(f"{folder}/headers").select("file").distinct()
    # A task per file: without a number, few names would be merged into one task.
    return names.repartition(max(1, names.count())).mapInArrow(_reader(folder, payloads), RECORD)


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """Per page its exact header and its payload, which a revisit gets from the response with its digest."""
    found = read_archive(spark, folder, payloads=True)
    headers = spark.read.schema(INDEX).parquet(f"{folder}/headers").select("page_id", "digest", "header")
    store = found.filter("record_type = 'response'").select(
        F.col("payload_digest").alias("digest"), "payload"
    ).dropDuplicates(["digest"])
    return headers.join(store, "digest").select("page_id", "header", "payload")


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive pages in a fresh shared folder, read the archive back, and tell what each record is."""
    spark = pages.sparkSession
    folder = work_path(spark, "warc")
    write_archive(pages, folder, min_bytes)
    found = stored(read_archive(spark, folder).drop("header", "payload"), "warc-read")
    sizes = (
        found.filter("record_type = 'response'")
        .groupBy(F.col("payload_digest").alias("of"))
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    sizes = stored(sizes, "warc-sizes")
    return found.join(small_side(sizes), F.col("payload_digest") == F.col("of"), "left").select(
        "page_id",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
