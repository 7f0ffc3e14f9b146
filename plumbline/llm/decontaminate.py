"""Benchmark passages in documents, found by winnowed fingerprints and extended word by word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, stored, table_bytes

GRAM = 5
ITEM_BLOCK_BYTES = 16 << 20

FOUND = "id long, mark long, n_words long, spans binary, items binary"
COVERED = "doc_id long, mark long, n_words long, n_hit long, items array<string>, spans array<struct<start: int, end: int>>"


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Indices kept: in every run of ``span`` neighbours the smallest hash, the first of equal ones."""
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    n = len(hashes) - span + 1
    least, at = hashes[:n].copy(), np.arange(n)
    for step in range(1, span):
        other = hashes[step : step + n]
        lower = other < least
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + step
    return np.unique(at)


class _Fingerprints:
    """Fingerprints of one kind: k-grams of items, sorted by hash."""

    def __init__(self, gram: int, span: int):
        self.gram, self.span = gram, span
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, hashes: np.ndarray, at: np.ndarray) -> None:
        self.found.append((hashes, at))

    def close(self) -> _Fingerprints:
        hashes, at = (np.concatenate(x) for x in zip(*self.found))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at = hashes[order], at[order]
        return self

    def matches(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a document's place and an item's place with the same hash."""
        low, high = (np.searchsorted(self.hashes, hashes, side) for side in ("left", "right"))
        hit = np.flatnonzero(high > low)
        times = (high - low)[hit]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at[hit], times), self.at[np.repeat(low[hit], times) + inner]


class Items:
    """A bounded block of benchmark texts: words one after another, and their fingerprints.

    Items of at least ``window`` words are winnowed: of every window the smallest
    k-gram hash is kept, so any shared span as long as a window shares a
    fingerprint at the same place. A shorter item is one window; it has a single
    gram, of its whole length.
    """

    def __init__(self, texts: list[bytes], window: int, gram: int):
        data, places = K.text_bytes(pa.array(texts, pa.binary()))
        words = K.Words(K.LOWER[data], places, K.WORD_BYTE)
        self.window, self.words = window, words.hashes
        self.begin, self.end = words.first[:-1], words.first[1:]
        kinds: dict[int, _Fingerprints] = {}
        for item, (i, j) in enumerate(zip(self.begin, self.end)):
            length = j - i
            if not length:
                continue
            long = length >= window
            k, span = (gram, window - gram + 1) if long else (length, 1)
            at = np.arange(i, j - k + 1)
            hashes = K.span_hashes(words.sums, at, at + k)
            kept = winnow(hashes, span)
            kinds.setdefault(0 if long else int(length), _Fingerprints(int(k), int(span))).add(hashes[kept], at[kept])
        self.kinds = {n: f.close() for n, f in kinds.items()}
        self.item_of = words.owner

    def spans(self, words: K.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the documents' words inside shared windows, and the item of each."""
        out = []
        for length, prints in self.kinds.items():
            hashes, at = words.grams(prints.gram)
            if length:
                place, other = prints.matches(hashes, at)
                out.append((place, place + length, self.item_of[other]))
                continue
            edges = K.runs(words.owner[at])
            kept = [winnow(hashes[i:j], prints.span) + i for i, j in zip(edges[:-1], edges[1:])]
            kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            place, other = prints.matches(hashes[kept], at[kept])
            out.append(self._extend(words, place, other, prints.gram))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))

    def _extend(self, words: K.Words, place: np.ndarray, other: np.ndarray, gram: int):
        """Follow each hit both ways for as long as words agree; spans shorter than a window go."""
        owner, item = words.owner[place], self.item_of[other]
        low = np.minimum(place - words.first[owner], other - self.begin[item])
        high = np.minimum(words.first[owner + 1] - place, self.end[item] - other)
        left, right = np.zeros(len(place), np.int64), np.full(len(place), gram)
        for reach, limit, sign in ((left, low, -1), (right, high, 1)):
            live = np.flatnonzero(reach < limit)
            while len(live):
                step = reach[live] + (1 if sign < 0 else 0)
                same = words.hashes[place[live] + sign * step] == self.words[other[live] + sign * step]
                live = live[same]
                reach[live] += 1
                live = live[reach[live] < limit[live]]
        long = left + right >= self.window
        return (place - left)[long], (place + right)[long], item[long]


def _find(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            data, places = K.text_bytes(batch.column("text"))
            counts, spans, found = [], [], []
            for i, j in K.blocks(places):
                low = K.LOWER[data[places[i] : places[j]]]
                words = K.Words(low, places[i : j + 1] - places[i], K.WORD_BYTE)
                start, end, item = items.spans(words)
                owner = words.owner[start] if len(start) else start
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(j - i + 1))
                for doc in range(j - i):
                    mine = order[cuts[doc] : cuts[doc + 1]]
                    first = words.first[doc]
                    pairs = np.unique(np.stack([start[mine] - first, end[mine] - first], 1).astype(np.int32), axis=0)
                    spans.append(pairs.tobytes())
                    found.append(np.unique(item[mine]).astype(np.int32).tobytes())
                counts.extend(words.counts.tolist())
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "mark": batch.column("mark"),
                    "n_words": pa.array(counts, pa.int64()),
                    "spans": pa.array(spans, pa.binary()),
                    "items": pa.array(found, pa.binary()),
                }
            )

    return run


def _find_and_cover(items: Items, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Both steps in one worker, for items that all are in block 0: two steps in a row take two workers a task."""
    find, cover = _find(items), _covered([names])
    head = (0).to_bytes(4, "little")

    def listed(batches):
        for batch in find(batches):
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "mark": batch.column("mark"),
                    "n_words": batch.column("n_words"),
                    "spans": pa.array([[x] for x in batch.column("spans").to_pylist()], pa.list_(pa.binary())),
                    "items": pa.array([[head + x] for x in batch.column("items").to_pylist()], pa.list_(pa.binary())),
                }
            )

    def run(batches):
        return cover(listed(batches))

    return run


def _covered(names: list[list[str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merge a document's spans and name its items; names are given by block."""

    def run(batches):
        for batch in batches:
            hits, intervals, found = [], [], []
            for row in batch.select(["spans", "items"]).to_pylist():
                pairs = np.frombuffer(b"".join(row["spans"] or []), np.int32).reshape(-1, 2)
                merged: list[list[int]] = []
                for i, j in sorted(pairs.tolist()):
                    if merged and i <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], j)
                    else:
                        merged.append([i, j])
                hits.append(sum(j - i for i, j in merged))
                intervals.append([{"start": i, "end": j} for i, j in merged])
                of = set()
                for part in row["items"] or []:
                    block, indices = part[0:4], np.frombuffer(part[4:], np.int32)
                    of.update(names[int.from_bytes(block, "little")][i] for i in indices)
                found.append(sorted(of))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("id"),
                    "mark": batch.column("mark"),
                    "n_words": batch.column("n_words"),
                    "n_hit": pa.array(hits, pa.int64()),
                    "items": pa.array(found, pa.list_(pa.string())),
                    "spans": pa.array(intervals, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                }
            )

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    marked: bool = False,
) -> DataFrame:
    """Per document its words inside passages shared with benchmark items, and which items those are.

    Words are runs of letters, digits and bytes beyond ASCII after lower-casing
    A-Z. A window is ``window`` consecutive words of an item; an item of fewer
    words, but not none, is one window. Documents and items are winnowed to the
    smallest k-gram hash of every window, equal fingerprints are joined, and each
    hit is extended word by word; so every shared span of a window or more is
    found whole.

    The benchmark is the given query set: it is taken in blocks of at most 16 MB
    (hashed by item), each broadcast to one pass over the documents; one block is
    the usual case and needs no shuffle.

    Per row: doc_id, n_words, n_hit, items (distinct ids as texts, sorted), spans
    of word positions; ``marked`` adds ``mark``, the xxhash64 of the text, which tells rows of
    one id apart. Null texts have no words. A null item id counts as an
    empty one. Repeated documents each get their row. Empty tables give no rows,
    or rows without hits. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    given = stored(
        benchmark.select(
            F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"),
            F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
        ),
        "benchmark",
    )
    count = max(1, -(-table_bytes(given) // ITEM_BLOCK_BYTES))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    names, passes = [], []
    for block in range(count):
        part = given.filter(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == block).collect()
        names.append([r.name for r in part])
        items = Items([r.text.encode() for r in part], window, gram)
        if count == 1:
            covered = rows.mapInArrow(K.tidy(_find_and_cover(items, names[0])), COVERED)
            return covered if marked else covered.drop("mark")
        found = rows.mapInArrow(K.tidy(_find(items)), FOUND)
        head = F.lit(block.to_bytes(4, "little"))
        passes.append(
            found.select("id", "mark", "n_words", "spans", F.concat(head, F.col("items")).alias("items"))
        )
    first, hits = passes[0], passes[0]
    for more in passes[1:]:
        hits = hits.unionByName(more)
    hits = (
        hits.filter(F.octet_length("spans") > 0)
        .groupBy("id", "mark")
        .agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    )
    keyed = first.select("id", "mark", "n_words")
    merged = keyed.join(hits, keyed.id.eqNullSafe(hits.id) & (keyed.mark == hits.mark), "left").select(
        keyed.id, keyed.mark, "n_words", "spans", "items"
    )
    covered = merged.select("id", "mark", "n_words", "spans", "items").mapInArrow(K.tidy(_covered(names)), COVERED)
    return covered if marked else covered.drop("mark")
