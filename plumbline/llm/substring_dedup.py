"""Removal of passages that an earlier document holds, by hashes of every word window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, shuffle_partitions, small_side, stored

CHUNK_WINDOWS = 1_500_000
BUCKET_BYTES = 8 << 20
ANCHOR_WORDS = 8

PACKED = "bucket int, ids binary, marks binary, bases binary, counts binary, steps binary, hashes binary"
SPANS = "id long, mark long, spans binary"


def _pack_bytes(parts: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {name: values.tobytes() for name, values in parts.items()}


class _Chunk:
    """Windows of a bounded part of a task's rows, on their way to the buckets of their anchors."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.ids, self.marks, self.rows = [], [], 0
        self.hashes, self.anchors, self.row_of, self.positions, self.windows = [], [], [], [], 0

    def add(self, ids, marks, hashes, anchors, owner, positions) -> None:
        self.ids.append(ids)
        self.marks.append(marks)
        self.hashes.append(hashes)
        self.anchors.append((anchors % np.uint64(self.buckets)).astype(np.int32))
        self.row_of.append((owner + self.rows).astype(np.int32))
        self.positions.append(positions.astype(np.int32))
        self.rows += len(ids)
        self.windows += len(hashes)

    def flush(self) -> Iterator[dict]:
        """One packed row per bucket, and one of the passages already decided within this chunk.

        Of the documents here that hold a window, all but the smallest have it
        removed whatever other chunks hold, so only the smallest one's windows
        travel: a window held by a third of all documents is sent once a chunk.
        """
        if not self.windows:
            return
        ids, marks = np.concatenate(self.ids), np.concatenate(self.marks)
        hashes, rows = np.concatenate(self.hashes), np.concatenate(self.row_of)
        positions, bucket = np.concatenate(self.positions), np.concatenate(self.anchors)
        decided = _not_smallest(hashes, ids[rows])
        if decided.any():
            yield {"bucket": int(bucket[0]), "steps": b"", "hashes": b""} | _pack_bytes(
                _as_spans(ids, marks, rows[decided], positions[decided])
            )
        hashes, rows, positions, bucket = (x[~decided] for x in (hashes, rows, positions, bucket))
        if self.buckets <= 1 << 16:
            bucket = bucket.astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        bucket, hashes, rows, positions = bucket[order], hashes[order], rows[order], positions[order]
        steps = np.zeros(len(positions), np.int64)
        steps[1:] = np.diff(positions)
        far = (steps > 0xFFFF).cumsum()  # a step too long for its two bytes begins a new run
        begin = K.runs(bucket, rows, far)
        steps[begin[:-1]] = 0
        for i, j in _pairs(K.runs(bucket)):
            a, b = np.searchsorted(begin, [i, j])
            at = begin[a:b]
            yield {"bucket": int(bucket[i])} | _pack_bytes(
                {
                    "ids": ids[rows[at]],
                    "marks": marks[rows[at]],
                    "bases": positions[at],
                    "counts": np.diff(begin[a : b + 1]).astype(np.int32),
                    "steps": steps[i:j].astype(np.uint16),
                    "hashes": hashes[i:j],
                }
            )


def _pairs(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _not_smallest(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows are also held under a smaller id."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(hashes), bool)
    shared[1:] |= same
    shared[:-1] |= same
    among, out = order[shared], np.zeros(len(hashes), bool)
    if len(among):
        edges = K.runs(hashes[among])
        least = np.minimum.reduceat(ids[among], edges[:-1])
        out[among] = ids[among] > np.repeat(least, np.diff(edges))
    return out


def _as_spans(ids, marks, rows, positions) -> dict[str, np.ndarray]:
    """Runs of consecutive window positions of a document: first position and length."""
    order = np.lexsort((positions, rows))
    rows, positions = rows[order], positions[order].astype(np.int64)
    edges = K.runs(rows, positions - np.arange(len(positions)))
    at = edges[:-1]
    return {
        "ids": ids[rows[at]],
        "marks": marks[rows[at]],
        "bases": positions[at].astype(np.int32),
        "counts": np.diff(edges).astype(np.int32),
    }


def _anchors(words: K.Words, at: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of the few-word grams inside each window.

    It names the window's bucket: equal windows share it, and so do most
    neighbours, which then travel and come back together.
    """
    k = min(ANCHOR_WORDS, window)
    starts = np.arange(max(0, len(words.hashes) - k + 1))
    least = K.sliding_least(K.span_hashes(words.sums, starts, starts + k), window - k + 1)
    return K.mix(least[at])


def _window_rows(window: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        chunk = _Chunk(buckets)
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            marks = batch.column("mark").to_numpy(zero_copy_only=False)
            data, places = K.text_bytes(batch.column("text"))
            for i, j in K.blocks(places):
                words = K.Words(data[places[i] : places[j]], places[i : j + 1] - places[i], K.NOT_SPACE)
                hashes, at = words.grams(window)
                owner = words.owner[at]
                chunk.add(ids[i:j], marks[i:j], hashes, _anchors(words, at, window), owner, at - words.first[owner])
                if chunk.windows >= CHUNK_WINDOWS:
                    yield from _batches(chunk.flush())
                    chunk = _Chunk(buckets)
        yield from _batches(chunk.flush())

    return run


def _batches(rows: Iterator[dict], size: int = 64) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("bucket", pa.int32())]
        + [(n, pa.binary()) for n in ("ids", "marks", "bases", "counts", "steps", "hashes")]
    )
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _count_bucket(table: pa.Table) -> pa.Table:
    """Count a bucket's hashes and return the windows that a smaller document also holds."""
    ids, marks, bases, counts, steps, hashes = ([] for _ in range(6))
    done = []
    for row in table.to_pylist():
        head = [np.frombuffer(row[n], t) for n, t in (("ids", np.int64), ("marks", np.int64), ("bases", np.int32), ("counts", np.int32))]
        if not row["hashes"]:
            done.append(head)
            continue
        for part, values in zip((ids, marks, bases, counts), head):
            part.append(values)
        steps.append(np.frombuffer(row["steps"], np.uint16))
        hashes.append(np.frombuffer(row["hashes"], np.uint64))
    if hashes:
        ids, marks, bases, counts = (np.concatenate(x) for x in (ids, marks, bases, counts))
        steps, hashes = np.concatenate(steps).astype(np.int64), np.concatenate(hashes)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        walked = np.cumsum(steps)
        run = np.repeat(np.arange(len(counts)), counts)
        positions = walked - walked[begin][run] + bases[run]
        removed = _not_smallest(hashes, ids[run])
        spans = _as_spans(ids, marks, run[removed], positions[removed])
        done.append([spans[n] for n in ("ids", "marks", "bases", "counts")])
    ids, marks, bases, counts = (np.concatenate(x) for x in zip(*done)) if done else [np.zeros(0, np.int64)] * 4
    order = np.lexsort((marks, ids))
    ids, marks = ids[order], marks[order]
    pairs = np.stack([bases[order], counts[order]], 1).astype(np.int32)
    edges = K.runs(ids, marks)
    return pa.table(
        {
            "id": pa.array(ids[edges[:-1]], pa.int64()),
            "mark": pa.array(marks[edges[:-1]], pa.int64()),
            "spans": pa.array([pairs[i:j].tobytes() for i, j in _pairs(edges)], pa.binary()),
        }
    )


def repeated_windows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Per document (id, mark of its text) the runs of windows that a smaller document holds too."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    ).filter("id IS NOT NULL AND text IS NOT NULL")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    packed = rows.mapInArrow(_window_rows(window, buckets), PACKED)
    found = packed.groupBy("bucket").applyInArrow(_count_bucket, SPANS)
    return found.groupBy("id", "mark").agg(F.collect_list("spans").alias("spans"))


def _without(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in K.slices(batches):
            texts, spans = batch.column("text").cast(pa.binary()), batch.column("spans")
            counts, removed, kept = [], [], []
            for raw, found in zip(texts, spans):
                words = (raw.as_py() or b"").split()  # at space and 0x09 to 0x0D
                n = len(words)
                if found.is_valid:
                    pairs = np.frombuffer(b"".join(found.as_py()), np.int32).reshape(-1, 2).astype(np.int64)
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, pairs[:, 0], 1)
                    np.add.at(cover, pairs[:, 0] + pairs[:, 1] - 1 + window, -1)
                    words = [words[i] for i in np.flatnonzero(cover.cumsum()[:n] == 0)]
                counts.append(n)
                removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("id"),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                }
            )

    return run


def substring_dedup(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every word covered by a window of words that also starts in a document with a smaller id.

    Words are runs of anything but space and 0x09 to 0x0D. Every window of
    ``window`` words inside a document gets a 64-bit Rabin-Karp hash; hashes are
    grouped by bucket in Spark (of the smallest short gram in the window) and
    counted there, and the windows found in a smaller document come back as runs
    of positions, merged into maximal intervals. Windows are judged on the input. Equal hashes count as equal
    windows (a chance of 2^-64 a pair).

    Per row: doc_id, n_words, n_removed, kept_text (kept words joined by a space).
    A null or short text has no window. Rows with a null id are neither compared
    nor cut. Rows that repeat an id don't remove each other's words; rows that
    share an id keep their own texts. Other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    spans = stored(repeated_windows(docs, window, id_col, text_col), "substring-spans")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    return (
        rows.join(small_side(spans), ["id", "mark"], "left")
        .select("id", "text", "spans")
        .mapInArrow(_without(window), "doc_id long, n_words long, n_removed long, kept_text string")
    )
