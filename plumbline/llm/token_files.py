"""Token-id files: flat unsigned integers, 64-bit document offsets, and a manifest."""

from __future__ import annotations

import itertools
import json
import os
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import work_path

from . import kernels as K
from .storage import ship_package

BYTE_BPE = "byte_bpe_50k.json"
CACHED_WORDS = 1_000_000
IDLE_SECONDS = 1.0  # after which a worker that writes no tokens drops what it remembers
SLICE_BYTES = 4 << 20  # of text encoded at a time; the larger, the fewer lookups
BYTE_SPACE = "\u0120"  # how a byte-level vocabulary writes a space
IS_LETTER = np.zeros(256, bool)  # of ASCII
IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b".,;:!?\n")] = True
IS_VISIBLE = np.zeros(256, bool)  # of ASCII
IS_VISIBLE[0x21:0x7F] = True
IS_LEAD = np.zeros(256, bool)  # first bytes of blocks without white space
IS_LEAD[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True
MANIFEST = "part int, name string, documents long, tokens long"


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a shared folder and the folder's path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), urlparse(folder).path
    return pa.fs.FileSystem.from_uri(folder)


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts piece by piece and remembers the ids of pieces it has seen.

    Texts are cut where the byte-level pre-tokenizer begins a new piece whatever stands around
    (``_cuts``), so the ids of the pieces, one after another, are those of the whole text. A place
    that is not sure is no cut, and makes a longer piece. Arrow tells the distinct pieces apart;
    each is looked up once per call and encoded once. Beyond ``limit`` pieces those go that came in
    one call only, which most pieces are.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        # Spark runs a task per core; the tokenizer's own threads would each hold memory beside it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.starts_with_space = np.zeros(max(vocabulary.values()) + 1, bool)
        self.starts_with_space[[i for t, i in vocabulary.items() if t[0] == BYTE_SPACE]] = True
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(1 << 18, np.int64)
        self.calls = np.zeros(1 << 18, np.int32)  # in which a piece came
        self.used, self.filled = 0, 0

    def _forget(self) -> None:
        """Go on with the pieces that came in most calls, half as many as the limit at most."""
        calls = self.calls[: self.used]
        kept = np.flatnonzero(calls > 1)
        if len(kept) > self.limit // 2:
            kept = kept[np.argsort(-calls[kept], kind="stable")[: self.limit // 2]]
        pieces = list(self.index)  # in the order of their numbers
        ids, sizes = self._ids_at(kept)
        self.clear()
        self._store([pieces[i] for i in kept.tolist()], ids, sizes)

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of ids of each."""
        if len(self.index) > self.limit:
            self._forget()
        data, places = K.text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        cuts = _cuts(data, places)
        coded = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = np.fromiter((self.index.get(p, -1) for p in distinct), np.int64, len(distinct))
        new = np.flatnonzero(known < 0)
        if len(new):
            unknown = [distinct[i] for i in new.tolist()]
            self._learn(unknown)
            known[new] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(new))
        self.calls[known] += 1  # each piece once
        ids, sizes = self._ids_at(known[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.searchsorted(cuts, places)])

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces: words with their space many at a time, others one by one."""
        words, others = [], []
        for p in pieces:
            plain = len(p) > 1 and p[0] == " " and not p[1].isspace() and p.rfind(" ") == 0
            (words if plain else others).append(p)
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            # Each word starts with the only space in it, so ids that start with one start a word.
            ids = np.array(self.tokenizer.encode("".join(part), add_special_tokens=False).ids, np.uint32)
            begin = np.flatnonzero(self.starts_with_space[ids])
            self._store(part, ids, np.diff(begin, append=len(ids)))
        for i in range(0, len(others), 4096):
            part = others[i : i + 4096]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32)
            self._store(part, flat, np.fromiter(map(len, found), np.int64, len(found)))

    def _store(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.filled + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.used + len(pieces) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.calls = np.concatenate([self.calls, np.zeros_like(self.calls)])
        self.ids[self.filled : self.filled + len(flat)] = flat
        self.begin[self.used + 1 : self.used + len(pieces) + 1] = self.filled + np.cumsum(sizes)
        self.index.update(zip(pieces, range(self.used, self.used + len(pieces))))
        self.filled += len(flat)
        self.used += len(pieces)

    def _ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known pieces, one after another, and how many each has."""
        sizes = self.begin[at + 1] - self.begin[at]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.arange(sizes.sum()) + np.repeat(self.begin[at] - before, sizes)], sizes


def _cuts(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where pieces begin in the UTF-8 bytes of texts that begin at ``places``, and the end of all.

    Every text begins a piece. Within one, the pre-tokenizer cuts, whatever stands around, before a
    space that a character other than white space follows, between a letter and a stop or line end,
    and between a letter and a line end before it, if a visible character precedes that.
    """
    size = len(data)
    whole = np.zeros(size + 4, np.uint8)  # two bytes on either side can be looked at
    whole[2:-2] = data
    cut = np.zeros(size + 1, bool)
    cut[places] = True
    at = np.flatnonzero(data == 0x20)
    at = at[~cut[at + 1]]  # else the text ends after the space
    spaces = at[_visible(whole[at + 3], whole[at + 4])]
    at = np.flatnonzero(IS_STOP[data])
    after = _letter(whole[at + 3], whole[at + 4])
    before = _letter_ends(whole[at], whole[at + 1])
    visible = before | IS_VISIBLE[whole[at + 1]]
    cut[spaces] = True
    cut[at[before]] = True
    cut[at[after & ((data[at] != 0x0A) | visible)] + 1] = True
    return np.append(np.flatnonzero(cut[:size]), size).astype(np.int64)


def _letter(byte: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Whether a letter of ASCII or Latin-1 begins with the byte."""
    return IS_LETTER[byte] | (byte == 0xC3) & (following != 0x97) & (following != 0xB7)


def _letter_ends(preceding: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Whether a letter of ASCII or Latin-1 ends with the byte."""
    return IS_LETTER[byte] | (preceding == 0xC3) & (byte != 0x97) & (byte != 0xB7)


def _visible(byte: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Whether a character begins with the byte that is neither white space nor a control, as far as two bytes tell."""
    wide = (byte == 0xE1) & (following != 0x9A) | (byte == 0xE2) & (following > 0x81) | (byte == 0xE3) & (following != 0x80)
    return IS_VISIBLE[byte] | IS_LEAD[byte] | wide


class _Kept:
    """A worker's encoders, kept from task to task while token tasks follow each other.

    A worker process outlives its stage, and what it remembers would lie beside the memory of all
    later stages: it is dropped when no task has asked for it for a while.
    """

    def __init__(self):
        self.encoders: dict[tuple[str, int], Encoder] = {}
        self.users = 0
        self.lock = threading.Lock()
        self.timer: threading.Timer | None = None

    @contextmanager
    def encoder(self, path: str, limit: int = CACHED_WORDS) -> Iterator[Encoder]:
        with self.lock:
            self.users += 1
            if self.timer:
                self.timer.cancel()
            if (path, limit) not in self.encoders:
                self.encoders[path, limit] = Encoder(path, limit)
            encoder = self.encoders[path, limit]
        try:
            yield encoder
        finally:
            with self.lock:
                self.users -= 1
                self.timer = threading.Timer(IDLE_SECONDS, self.drop)
                self.timer.daemon = True
                self.timer.start()

    def drop(self) -> None:
        with self.lock:
            if not self.users:
                self.encoders.clear()
                K.release()


_KEPT = _Kept()


def _encoder(path: str, limit: int = CACHED_WORDS) -> AbstractContextManager[Encoder]:
    """The worker's encoder, held while it is used."""
    return _KEPT.encoder(path, limit)


def check_tokenizer(path: str, width: int) -> None:
    """Refuse a vocabulary whose ids do not fit ``width`` bytes, or one that is not cut into pieces at spaces."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    vocabulary = described["model"].get("vocab", {})
    numbers = vocabulary.values() if isinstance(vocabulary, dict) else range(len(vocabulary))
    largest = max([*numbers, *[t["id"] for t in described.get("added_tokens") or []]], default=0)
    if largest >= 1 << 8 * width:
        raise ValueError(f"id {largest} does not fit {width} bytes")
    cutter = described.get("pre_tokenizer") or {}
    kinds = {cutter.get("type"), *[c.get("type") for c in cutter.get("pretokenizers", [])]}
    if "ByteLevel" not in kinds or described.get("normalizer"):
        raise ValueError("only byte-level tokenizers without a normalizer cut texts at spaces")


def _write(
    folder: str, path: str, end_id: int, width: int, limit: int, slice_bytes: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = np.dtype(f"<u{width}")

    def run(batches):
        from pyspark import TaskContext

        with _encoder(path, limit) as encoder:
            yield from written(batches, encoder, TaskContext.get().partitionId())

    def written(batches, encoder, number):
        files, base = open_folder(folder)
        # A name of this attempt's own: only names in the committed manifest count.
        name = f"part-{number:06d}-{uuid.uuid4().hex}"
        offsets, ids, valid, documents, tokens = [np.zeros(1, np.uint64)], [], [], 0, 0
        out = None
        for batch in batches:
            for i, j in K.blocks(K.text_bytes(batch.column("text"))[1], slice_bytes):
                part = batch.slice(i, j - i)
                flat, sizes = encoder.encode(part.column("text"))
                ends = np.cumsum(sizes + 1)
                whole = np.empty(len(flat) + len(sizes), kind)
                last = np.zeros(len(whole), bool)
                last[ends - 1] = True
                whole[~last], whole[last] = flat, end_id
                out = out or files.open_output_stream(f"{base}/{name}.ids")
                out.write(whole.tobytes())
                offsets.append((ends + tokens).astype(np.uint64))
                ids.append(part.column("id").fill_null(0).to_numpy(zero_copy_only=False))
                valid.append(part.column("id").is_valid().to_numpy(zero_copy_only=False))
                tokens += len(whole)
                documents += part.num_rows
        if out is None:
            return
        out.close()
        for suffix, values in (
            ("offsets", np.concatenate(offsets).astype("<u8")),
            ("docs", np.concatenate(ids).astype("<i8")),
            ("known", np.concatenate(valid).astype("u1")),
        ):
            with files.open_output_stream(f"{base}/{name}.{suffix}") as other:
                other.write(values.tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([number], pa.int32()),
                "name": [name],
                "documents": pa.array([documents], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
            }
        )

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = 0,
    width: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = CACHED_WORDS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Write documents as token ids in ascending id order and return the manifest of the files.

    Documents are range-partitioned and sorted by id; each task encodes its range
    and writes flat little-endian unsigned integers of ``width`` bytes
    (``.ids``), 64-bit offsets of its documents with the end as last entry
    (``.offsets``), and the ids (``.docs``, with ``.known`` 0 for a null one). Every document is
    followed by ``end_id``. The manifest is a Parquet table that Spark commits: an
    attempt that was lost leaves files that it doesn't name.

    Null texts are empty: they hold the end id alone. Null ids come first. Rows
    that repeat an id follow each other, ordered by text. Other columns are not
    read. An empty table gives an empty manifest. A vocabulary with ids beyond ``width``
    bytes, or one that is not byte-level, is refused. ``limit`` (pieces remembered) and ``slice_bytes``
    (text encoded at a time) trade a worker's memory for time, with the same files.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    check_tokenizer(tokenizer, width)
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    placed = rows.repartitionByRange("id").sortWithinPartitions(F.asc_nulls_first("id"), "text")
    files, base = open_folder(folder)
    files.create_dir(f"{base}/tokens", recursive=True)
    manifest = placed.mapInArrow(
        _write(f"{folder}/tokens", tokenizer, end_id, width, limit, slice_bytes), MANIFEST
    )
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, and what precedes each: prefix sums over the parts."""
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("part").collect()
    rows, base = [], 0
    for p in parts:  # one row per task that wrote
        rows.append((p.part, p.name, p.documents, p.tokens, base))
        base += p.tokens
    return spark.createDataFrame(rows, f"{MANIFEST}, base long")


def map_file(folder: str, name: str, kind: str) -> np.ndarray:
    """A file's integers: memory-mapped where the folder is mounted, else read."""
    files, base = open_folder(folder)
    path = f"{base}/tokens/{name}"
    if isinstance(files, pa.fs.LocalFileSystem):
        size = files.get_file_info(path).size
        return np.memmap(path, kind, "r") if size else np.zeros(0, kind)
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _read(folder: str, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        import zlib

        for batch in batches:
            for row in batch.to_pylist():
                ids = map_file(folder, f"{row['name']}.ids", f"<u{width}")
                offsets = map_file(folder, f"{row['name']}.offsets", "<u8").astype(np.int64)
                known = map_file(folder, f"{row['name']}.known", "u1")
                docs = map_file(folder, f"{row['name']}.docs", "<i8")
                for i in range(0, len(docs), 4096):
                    j = min(i + 4096, len(docs))
                    sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1])]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(docs[i:j], pa.int64(), mask=known[i:j] == 0),
                            "start": pa.array(offsets[i:j] + row["base"], pa.int64()),
                            "n_tokens": pa.array(np.diff(offsets[i : j + 1]), pa.int64()),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    return run


def read_tokens(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    """Per document what the files hold: where its ids start among all ids, how many, their CRC-32."""
    ship_package(spark)
    manifest = read_manifest(spark, folder)
    count = manifest.count()
    return manifest.repartition(max(1, count), "part").mapInArrow(
        _read(folder, width), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def encode_documents(
    docs: DataFrame, tokenizer: str | None = None, limit: int = CACHED_WORDS, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Write documents to files of token ids in a fresh shared folder and read them back."""
    folder = work_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, limit=limit, slice_bytes=slice_bytes)
    return read_tokens(docs.sparkSession, folder)
