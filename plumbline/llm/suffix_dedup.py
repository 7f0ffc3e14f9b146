"""Removal of byte strings that occur twice, by merged Burrows-Wheeler transforms of candidate segments."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, shuffle_partitions, small_side, stored

GRAM = 0.16  # of the window: bytes of an anchor, and window starts that share a core
SYMBOL = 50  # bytes of a symbol of the transform
CHUNK_GROUPS = 300_000
BUCKET_BYTES = 16 << 20
SHARD_BYTES = 256 << 10  # of a transform before merging
TASK_BYTES = 1 << 20  # of segments merged in one task, which holds some eighty times as much
CROWDED = 1500  # distinct segments around one core, beyond which they are spread out

PACKED = "bucket int, marks binary, counts binary, cores binary, digests binary, places binary"
GROUPS = "core long, digest long, mark long, lo int, n int"
SEGMENT = "shard long, mark long, lo int, n int, single boolean, bytes binary"
SPANS = "mark long, lo int, n int"


def window_groups(data: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Groups of neighbouring window starts of each text: text, first start, number, core, digest.

    A window's anchor is the smallest hash of the k-grams inside it, so equal windows
    have it at the same place. Windows with one anchor whose starts are alike in
    distance from it (by steps of as many bytes) form a group. They all cover the group's
    core, so windows of two groups can only be equal if the cores are. The
    digest tells the whole bytes that the group's windows cover.
    """
    size = len(data)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if size < window:
        return none
    k = group = max(1, int(GRAM * window))
    sums = K.prefix_sums(data.astype(np.uint64) + np.uint64(1))
    at = np.arange(size - k + 1)
    bits = np.uint64(max(22, size.bit_length()))
    # Hash above, place below: the smallest is the first of the smallest hashes.
    ranked = (K.span_hashes(sums, at, at + k) >> bits << bits) | at.astype(np.uint64)
    anchor = (K.sliding_least(ranked, window - k + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(places) - 1), np.diff(places))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + window <= places[owner + 1])
    if not len(start):
        return none
    anchor = anchor[start]
    step = (anchor - start) // group
    first = K.runs(anchor, step)
    low, count = start[first[:-1]], np.diff(first)
    anchor, step = anchor[first[:-1]], step[first[:-1]]
    core = K.span_hashes(sums, anchor - step * group, anchor - (step + 1) * group + 1 + window)
    core = K.mix(core + step.astype(np.uint64))
    digest = K.span_hashes(sums, low, low + count - 1 + window)
    digest = K.mix(digest * np.uint64(K.BASE) + (anchor - low).astype(np.uint64))
    text = owner[low]
    return text, low - places[text], count, core, digest


class _Chunk:
    """Groups of a bounded part of a task's rows, on their way to the buckets of their cores."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.groups = buckets, [], 0

    def add(self, marks, text, low, count, core, digest) -> None:
        self.parts.append((marks[text], low, count, core, digest))
        self.groups += len(text)

    def flush(self) -> Iterator[dict]:
        """Cores that occur twice here are known to be shared; one of each travels, to tell others."""
        if not self.groups:
            return
        marks, low, count, core, digest = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(core, kind="stable")
        edges = K.runs(core[order])
        times = np.repeat(np.diff(edges), np.diff(edges))
        shared = np.zeros(len(core), bool)
        shared[order] = times > 1
        told = np.zeros(len(core), bool)
        told[order[edges[:-1]]] = True
        known = np.flatnonzero(shared)
        if len(known):
            yield {"bucket": int(core[known[0]] % np.uint64(self.buckets))} | self._row(
                known, marks, low, count, core, digest, known=2
            )
        sent = np.flatnonzero(told)
        bucket = (core[sent] % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        sent, bucket = sent[by], bucket[by]
        edges = K.runs(bucket)
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield {"bucket": int(bucket[i])} | self._row(
                sent[i:j], marks, low, count, core, digest, known=shared[sent[i:j]]
            )

    @staticmethod
    def _row(chosen, marks, low, count, core, digest, known) -> dict:
        edges = K.runs(marks[chosen])
        # First start, number of starts, and what is known: 0 nothing, 1 shared and already told, 2 to be told.
        place = np.empty((len(chosen), 3), np.int32)
        place[:, 0], place[:, 1], place[:, 2] = low[chosen], count[chosen], known
        return {
            "marks": marks[chosen][edges[:-1]].tobytes(),
            "counts": np.diff(edges).astype(np.int32).tobytes(),
            "cores": core[chosen].tobytes(),
            "digests": digest[chosen].tobytes(),
            "places": place.T.tobytes(),
        }


def _group_rows(window: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("marks", "counts", "cores", "digests", "places")])

    def batches_of(rows):
        held = []
        for row in rows:
            held.append(row)
            if len(held) == 64:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    def run(batches):
        chunk = _Chunk(buckets)
        for batch in batches:
            marks = batch.column("mark").to_numpy(zero_copy_only=False)
            data, places = K.text_bytes(batch.column("text"))
            for i, j in K.blocks(places):
                chunk.add(marks[i:j], *window_groups(data[places[i] : places[j]], places[i : j + 1] - places[i], window))
                if chunk.groups >= CHUNK_GROUPS:
                    yield from batches_of(chunk.flush())
                    chunk = _Chunk(buckets)
        yield from batches_of(chunk.flush())

    return run


def _shared_groups(table: pa.Table) -> pa.Table:
    """The groups of a bucket whose core occurs twice."""
    parts, done = [], []
    for row in table.to_pylist():
        counts = np.frombuffer(row["counts"], np.int32)
        marks = np.repeat(np.frombuffer(row["marks"], np.int64), counts)
        place = np.frombuffer(row["places"], np.int32).reshape(3, -1)
        part = (marks, place[0], place[1], place[2], np.frombuffer(row["cores"], np.int64), np.frombuffer(row["digests"], np.int64))
        (done if len(place[2]) and place[2][0] == 2 else parts).append(part)
    if parts:
        found = [np.concatenate(x) for x in zip(*parts)]
        order = np.argsort(found[4], kind="stable")
        edges = K.runs(found[4][order])
        twice = np.zeros(len(order), bool)
        twice[order] = np.repeat(np.diff(edges), np.diff(edges)) > 1
        chosen = twice & (found[3] == 0)
        done.append(tuple(x[chosen] for x in found))
    marks, low, count, _, core, digest = [np.concatenate(x) for x in zip(*done)] if done else [np.zeros(0, np.int64)] * 6
    return pa.table(
        {
            "core": pa.array(core, pa.int64()),
            "digest": pa.array(digest, pa.int64()),
            "mark": pa.array(marks, pa.int64()),
            "lo": pa.array(low, pa.int32()),
            "n": pa.array(count, pa.int32()),
        }
    )


class Transform:
    """The Burrows-Wheeler transform of a shard of segments, over symbols of SYMBOL bytes.

    A segment is read as SYMBOL strings, one for each residue of the position; the
    suffix at a position is followed by the one SYMBOL bytes on. Symbols are 64-bit
    hashes, ordered by value. ``places`` are the positions of the sorted suffixes, ``before``
    the symbol that precedes each, ``begins`` where none does.
    """

    def __init__(self, segments: list[bytes], symbol: int = SYMBOL):
        data = np.frombuffer(b"".join(segments), np.uint8)
        n = len(data) + len(segments)
        kind = np.int32 if n < 1 << 31 else np.int64  # of positions
        sizes = np.array([len(s) for s in segments], kind)
        ends = np.cumsum(sizes, dtype=kind)
        # One position more than bytes in a segment: the empty suffixes of its strings end there.
        self.first = ends - sizes + np.arange(len(sizes), dtype=kind)
        self.sizes = sizes
        owner = np.repeat(np.arange(len(sizes), dtype=kind), sizes + 1)
        offset = np.arange(n, dtype=kind) - self.first[owner]
        byte = np.minimum(np.arange(n, dtype=kind) - owner, kind(len(data)))
        full = np.flatnonzero(offset + symbol <= sizes[owner]).astype(kind)
        sums = K.prefix_sums(data.astype(np.uint64) + np.uint64(1))
        code = np.zeros(n, np.uint64)
        code[full] = K.span_hashes(sums, byte[full], byte[full] + symbol)
        # Positions in strings of one symbol at least; the others hold no window.
        self.owner, self.offset = owner, offset
        follows = offset >= symbol
        empty = np.flatnonzero((offset + symbol > sizes[owner]) & follows).astype(kind)
        order = np.concatenate([empty, full])
        for _ in range(int(sizes.max(initial=0)) // symbol + 1):
            earlier = order[follows[order]] - symbol
            order = np.concatenate([empty, earlier[np.argsort(code[earlier], kind="stable")]])
        self.places = order
        self.begins = ~follows[order]
        self.before = np.where(self.begins, np.uint64(0), code[np.maximum(order - symbol, 0)])
        self.empties = len(empty)


def merged_blocks(shards: list[Transform], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave shards' transforms until suffixes are ordered by their first ``symbols`` symbols.

    Each round walks the present interleave, takes the symbol before each suffix,
    and hands its slot on to the bucket of that symbol; suffixes then agree with the
    true order in one symbol more. Where the symbol or the block of the suffix behind it
    changes, a new block begins, so a block in the end holds the suffixes that share so many
    symbols: their common prefix. No suffix is sorted again. Returns the shard of every
    slot and its block.
    """
    counts = [len(s.places) for s in shards]
    kind = np.int32 if sum(counts) < 1 << 31 else np.int64
    empties = np.repeat(np.arange(len(shards), dtype=kind), [s.empties for s in shards])
    before = np.concatenate([s.before for s in shards])
    begins = np.concatenate([s.begins for s in shards])
    of = np.repeat(np.arange(len(shards), dtype=kind), counts)
    block = np.zeros(len(of), kind)
    for _ in range(symbols):
        walk = np.argsort(of, kind="stable")  # a shard's slots, in its own order
        symbol, ends = np.empty(len(of), np.uint64), np.empty(len(of), bool)
        symbol[walk], ends[walk] = before, begins
        inner = np.flatnonzero(~ends)
        inner = inner[np.argsort(symbol[inner], kind="stable")]
        new = np.zeros(len(of), bool)
        e = len(empties)
        if len(inner):
            new[e] = True
            new[e + 1 :] = (symbol[inner][1:] != symbol[inner][:-1]) | (block[inner][1:] != block[inner][:-1])
        of = np.concatenate([empties, of[inner]])
        block = new.cumsum(dtype=kind)
    return of, block


def repeated_starts(segments: list[bytes], window: int, symbol: int) -> list[np.ndarray]:
    """Per segment the starts of windows that occur elsewhere among the segments."""
    shards, held, size = [], [], 0
    for s in segments:
        held.append(s)
        size += len(s)
        if size >= SHARD_BYTES:
            shards.append(Transform(held, symbol))
            held, size = [], 0
    if held:
        shards.append(Transform(held, symbol))
    of, block = merged_blocks(shards, window // symbol)
    walk = np.argsort(of, kind="stable")
    block = block[walk]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(segments)
    segment, offset, valid, base = [], [], [], 0
    for s in shards:
        owner = s.owner[s.places]
        segment.append(owner + base)
        offset.append(s.offset[s.places])
        valid.append(s.offset[s.places] + window <= s.sizes[owner])
        base += len(s.sizes)
    segment, offset, valid = (np.concatenate(x) for x in (segment, offset, valid))
    members = np.bincount(block[valid], minlength=int(block.max(initial=0)) + 1)
    hit = valid & (members[block] > 1)
    segment, offset = segment[hit], offset[hit]
    order = np.lexsort((offset, segment))
    segment, offset = segment[order], offset[order]
    edges = K.runs(segment)
    for i, j in zip(edges[:-1], edges[1:]):
        if j > i:
            out[segment[i]] = offset[i:j]
    return out


def _symbol_of(window: int) -> int:
    """The largest divisor of the window that is not above SYMBOL."""
    return max(s for s in range(1, min(SYMBOL, window) + 1) if window % s == 0)


def _merge_task(window: int) -> Callable[[pa.Table], pa.Table]:
    def run(table):
        rows = table.to_pylist()
        found = repeated_starts([r["bytes"] for r in rows], window, _symbol_of(window))
        marks, low, count = [], [], []
        for row, starts in zip(rows, found):
            if not row["single"] or not len(starts):
                continue
            edges = K.runs(starts - np.arange(len(starts)))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                marks.append(row["mark"])
                low.append(row["lo"] + int(starts[i]))
                count.append(j - i)
        return pa.table(
            {"mark": pa.array(marks, pa.int64()), "lo": pa.array(low, pa.int32()), "n": pa.array(count, pa.int32())}
        )

    return run


def _cut_segments(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes asked for of each text."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("text")[i].as_py().encode()
                rows = [
                    r | {"mark": batch.column("mark")[i].as_py(), "bytes": raw[r["lo"] : r["lo"] + r["n"] - 1 + window]}
                    for r in batch.column("asked")[i].as_py()
                ]
                yield pa.RecordBatch.from_pylist(
                    rows,
                    pa.schema(
                        [
                            ("shard", pa.int64()), ("mark", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()),
                            ("single", pa.bool_()), ("bytes", pa.binary()),
                        ]
                    ),
                )

    return run


def _window_hashes(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            data, places = K.text_bytes(batch.column("bytes"))
            counts = np.diff(places) - window + 1
            sums = K.prefix_sums(data.astype(np.uint64) + np.uint64(1))
            row = np.repeat(np.arange(batch.num_rows), counts)
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at = places[row] + inner
            low = batch.column("lo").to_numpy()[row] + inner
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": pa.array(K.span_hashes(sums, at, at + window).view(np.int64)),
                    "mark": batch.column("mark").take(pa.array(row)),
                    "lo": pa.array(low, pa.int32()),
                    "single": batch.column("single").take(pa.array(row)),
                }
            )

    return run


def repeated_spans(docs: DataFrame, window: int, text_col: str, crowded: int = CROWDED) -> DataFrame:
    """Runs of window starts (mark of the text, first, number) whose windows occur elsewhere."""
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")).filter(
        F.octet_length("text") >= window
    )
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    groups = stored(
        texts.mapInArrow(K.tidy(_group_rows(window, buckets)), PACKED)
        .groupBy("bucket")
        .applyInArrow(K.tidy_group(_shared_groups), GROUPS),
        "shared-groups",
    )
    classes = stored(
        groups.groupBy("core", "digest").agg(
            F.count("*").alias("times"), F.min(F.struct("mark", "lo", "n")).alias("one")
        ),
        "group-classes",
    )
    whole = classes.filter("times > 1").select("core", "digest")
    spans = groups.join(small_side(whole), ["core", "digest"], "left_semi").select("mark", "lo", "n")
    several = classes.groupBy("core").agg(F.count("*").alias("classes")).filter("classes > 1")
    mixed = stored(
        classes.join(small_side(stored(several, "mixed-cores")), "core").select(
            "core", "digest", "one.*", (F.col("times") == 1).alias("single"), "classes"
        ),
        "mixed-classes",
    )
    asked_bytes = mixed.agg(F.sum(F.col("n") + window)).first()[0] or 0
    if not asked_bytes:
        return spans
    tasks = max(shuffle_partitions(spark), -(-asked_bytes // TASK_BYTES))
    shard = F.when(F.col("classes") > crowded, F.lit(-1)).otherwise(F.pmod("core", F.lit(tasks)))
    asked = stored(
        mixed.groupBy(F.col("mark").alias("of")).agg(
            F.collect_list(F.struct(shard.alias("shard"), "lo", "n", "single")).alias("asked")
        ),
        "asked-segments",
    )
    one_text = (
        texts.join(_few(asked), texts.mark == F.col("of")).select("mark", "text", "asked").dropDuplicates(["mark"])
    )
    segments = stored(one_text.mapInArrow(K.tidy(_cut_segments(window)), SEGMENT), "segments")
    merged = segments.filter("shard >= 0").groupBy("shard").applyInArrow(K.tidy_group(_merge_task(window)), SPANS)
    hashes = stored(
        segments.filter("shard < 0").mapInArrow(
            K.tidy(_window_hashes(window)), "hash long, mark long, lo int, single boolean"
        ),
        "crowded-windows",
    )
    twice = hashes.groupBy("hash").agg(F.count("*").alias("times")).filter("times > 1").select("hash")
    crowd = hashes.filter("single").join(twice, "hash", "left_semi").select("mark", "lo", F.lit(1).alias("n"))
    return spans.union(merged).union(crowd)


def _few(asked: DataFrame) -> DataFrame:
    """Requests for segments, broadcast if their measured size allows it."""
    rows = asked.agg(F.sum(F.size("asked") * 24 + 16)).first()[0] or 0
    return F.broadcast(asked) if rows <= 32 << 20 else asked


def _without(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in K.slices(batches):
            sizes, removed, runs, digests = [], [], [], []
            for i in range(batch.num_rows):
                raw = (batch.column("text")[i].as_py() or "").encode()
                found = batch.column("spans")[i].as_py()
                kept, gone, count = raw, 0, 0
                if found:
                    pieces, at = [], 0
                    merged: list[list[int]] = []
                    for low, high in sorted((s["lo"], s["lo"] + s["n"] - 1 + window) for s in found):
                        if merged and low <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], high)
                        else:
                            merged.append([low, high])
                    for low, high in merged:
                        pieces.append(raw[at:low])
                        gone += high - low
                        at = high
                    kept, count = b"".join([*pieces, raw[at:]]), len(merged)
                sizes.append(len(raw))
                removed.append(gone)
                runs.append(count)
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("id"),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(runs, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
            )

    return run


def suffix_dedup(
    docs: DataFrame, window: int = 400, crowded: int = CROWDED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every byte covered by a string of ``window`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; strings don't cross documents and are judged on the input;
    starts in the same document count, overlapping ones too.

    1. Windows are grouped by anchor (see ``window_groups``); groups whose core occurs
       once are done. Cores are counted in Spark, twice in a task sent once.
    2. Groups equal in all their bytes repeat as a whole; one of each is kept.
    3. Where different groups share a core, the bytes of one group of each kind go to
       the task of the core. There each shard of segments has its Burrows-Wheeler
       transform, and transforms are merged by interleave refinement up to ``window``
       bytes; blocks of the merged order are the repeated strings.
    4. A core with more than ``crowded`` different surroundings would crowd one task: its
       windows are hashed one by one and counted in Spark instead.

    Hashes have 64 bits; equal ones count as equal bytes. Null texts are empty; texts
    shorter than the window lose nothing. Results depend on the text alone, so null and repeated ids
    make no difference: rows repeated as a whole remove each other's bytes. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    spans = stored(repeated_spans(docs, window, text_col, crowded), "suffix-spans")
    # Copies of a text name the same spans; each counts once.
    by_text = stored(
        spans.distinct().groupBy(F.col("mark").alias("of")).agg(F.collect_list(F.struct("lo", "n")).alias("spans")), "text-spans"
    )
    total = by_text.agg(F.sum(F.size("spans") * 8 + 16)).first()[0] or 0
    side = F.broadcast(by_text) if total <= 32 << 20 else by_text
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    return (
        rows.join(side, rows.mark == F.col("of"), "left")
        .select("id", "text", "spans")
        .mapInArrow(
            K.tidy(_without(window)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
    )
