"""SimHash near duplicates: fingerprints dealt to the anchors of a covering code and compared per anchor."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .near_dedup import connected_components
from .storage import ship_package, small_side, stored

SEED = 42
BITS = 64
RUN_BYTES = 1 << 20  # of a text whose words are held at a time
CROWDED = 4096  # members of an anchor that are compared in one go; more are dealt to finer anchors first
PAIRWISE = 12  # members up to which all pairs are looked at side by side
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about RUN_BYTES."""
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > RUN_BYTES and (gap := SPACE.search(raw, at + RUN_BYTES)):
            end = gap.end()
        yield raw[at:end].lower().split()  # of bytes: A-Z only, and white space is 0x20 and 0x09 to 0x0D
        at = end


def fingerprint(raw: bytes, k: int) -> int:
    """Bits that are set in over half of the hashes of a text's shingles, repeats included; 0 without words."""
    counts, n, carried = np.zeros(BITS, np.int64), 0, []
    for words in _word_runs(raw):
        words = carried + words
        hashes = [xxhash.xxh64_digest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(k))))]
        if hashes:
            bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8)).reshape(-1, BITS)
            counts += bits.sum(0, dtype=np.int32)
            n += len(hashes)
        carried = words[max(0, len(words) - k + 1) :]
    if not n and carried:
        whole = np.frombuffer(xxhash.xxh64_digest(b" ".join(carried), SEED), np.uint8)
        counts, n = np.unpackbits(whole).astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def _fingerprints(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in K.slices(batches):
            data, places = K.text_bytes(batch.column("text"))
            found = [fingerprint(data[i:j].tobytes(), k) for i, j in zip(places[:-1], places[1:])]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "print": pa.array(found, pa.int64())})

    return run


def block_anchors(block: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors that blocks of ``width`` = 2^r bits are dealt to, one row per block, and which of them hold one.

    Anchors are the words of a covering code: the perfect Hamming code on the lower
    2^r - 1 bits, of covering radius 1, times all values of the highest bit, of radius
    0. The first column is a block's own anchor, the nearest one. A row holds all anchors
    whose own blocks may be one bit away: those within radius + 1 in the lower bits, and
    the own anchor with the highest bit turned.
    """
    places = np.arange(1, width, dtype=np.uint64)  # bit p - 1 has place p
    one = np.uint64(1)
    syndrome = np.zeros(len(block), np.uint64)
    for r in range(width.bit_length() - 1):
        at = (places >> np.uint64(r)) & one == one
        parity = np.bitwise_count(block & np.bitwise_or.reduce(one << (places[at] - one))).astype(np.uint64) & one
        syndrome |= parity << np.uint64(r)
    off = syndrome > 0
    own = np.where(off, block ^ (one << (np.maximum(syndrome, one) - one)), block)
    # Two places that cancel the syndrome lead to another word of the code.
    partner = places[None, :] ^ syndrome[:, None]
    further = block[:, None] ^ (one << (places - one))[None, :] ^ (one << (np.maximum(partner, one) - one))
    return (
        np.concatenate([own[:, None], (own ^ (one << np.uint64(width - 1)))[:, None], further], axis=1),
        np.concatenate([np.ones((len(block), 2), bool), off[:, None] & (partner > places)], axis=1),
    )


def _dealt(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members of the anchors of a level, from fingerprints (level 0) or from the members of crowded anchors.

    Of two fingerprints at most 3 bits apart, one half is at most one bit apart. In a
    crowded anchor that is the half it stands for, so the other half is at most 3
    apart, and one of its halves at most one: the same step on ever smaller blocks. Which blocks
    led to an anchor, and its words there, make up its name, which fits 64 bits.
    """
    width = BITS >> level + 1
    name_bits = sum((BITS >> done + 1) + 1 for done in range(level))

    def run(batches):
        for batch in K.slices(batches, 4096):
            prints = batch.column("print").to_numpy().view(np.uint64)
            if level:
                name, home = batch.column("anchor").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)
            else:
                name, home = np.zeros(len(prints), np.uint64), np.ones(len(prints), bool)
            # The block still free: after every choice, the half that was not chosen.
            start = np.zeros(len(prints), np.uint64)
            shift = 0
            for done in range(level):
                half = np.uint64(BITS >> done + 1)
                chosen = (name >> np.uint64(shift)) & np.uint64(1)
                start += np.where(chosen == 0, half, np.uint64(0))
                shift += int(half) + 1
            for which in (0, 1):
                block = (prints >> (start + np.uint64(which * width))) & np.uint64((1 << width) - 1)
                words, there = block_anchors(block, width)
                row, column = np.nonzero(there)
                anchor = name[row] | (np.uint64(which) | words[row, column] << np.uint64(1)) << np.uint64(name_bits)
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array(anchor.view(np.int64)),
                        "print": pa.array(prints[row].view(np.int64)),
                        "home": pa.array(home[row] & (column == 0)),
                    }
                )

    return run


def joined(prints: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each class of fingerprints linked at ``bits`` or fewer, step by step: its first one, and more of it.

    A breadth-first walk that looks at what is not yet reached only: as many pairs come
    out as are joined, however many links there are.
    """
    rest = prints
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        waiting = [root]
        while waiting and len(rest):
            near = np.bitwise_count(rest ^ waiting.pop()) <= bits
            if near.any():
                found, rest = rest[near], rest[~near]
                yield root, found
                waiting.extend(found)


def _compared(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs that join the members of every anchor; members arrive sorted by anchor."""

    def pairs(names: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cuts = K.runs(names)
        starts, sizes = cuts[:-1], np.diff(cuts)
        for size in np.unique(sizes[(sizes > 1) & (sizes <= PAIRWISE)]):
            group = prints[starts[sizes == size][:, None] + np.arange(size)]
            i, j = np.triu_indices(size, 1)
            a, b = group[:, i].reshape(-1), group[:, j].reshape(-1)
            near = np.bitwise_count(a ^ b) <= bits
            yield a[near], b[near]
        for at, size in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE]):
            for root, found in joined(prints[at : at + size], bits):
                yield np.full(len(found), root, np.uint64), found

    def run(batches):
        names, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            names = np.concatenate([names, batch.column("anchor").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
            if not len(names):
                continue
            whole = int(np.searchsorted(names, names[-1]))  # the last anchor may go on in the next batch
            yield from _links(pairs(names[:whole], prints[:whole]))
            names, prints = names[whole:], prints[whole:]
        yield from _links(pairs(names, prints))

    def _links(found):
        for a, b in found:
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return run


def anchored_links(nodes: DataFrame, bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``print`` that join all which are linked through some anchor.

    A pair at most 3 bits apart meets at the own anchor of either. An anchor is worth looking at if it
    is some member's own and has another member. Members of an anchor with more than ``crowded``
    are dealt again, to anchors on the bits that theirs leaves open, before they are
    brought together; anchors still crowded after the smallest blocks hold fingerprints that
    agree nearly everywhere, and are walked as they are.
    """
    if not 0 <= bits <= 3:
        raise ValueError("anchors are laid for at most 3 differing bits")
    links = None
    level, members = 0, nodes.select("print")
    while True:
        members = stored(
            members.mapInArrow(_dealt(level), "anchor long, print long, home boolean"), f"anchor-members-{level}"
        )
        sizes = members.groupBy(F.col("anchor").alias("of")).agg(F.count("*").alias("n"), F.max("home").alias("owned"))
        sizes = stored(sizes.filter("n > 1 AND owned").select("of", "n"), f"anchor-sizes-{level}")
        last = BITS >> level + 2 < 4
        usual = sizes if last else sizes.filter(F.col("n") <= crowded)
        found = (
            members.join(usual.select("of"), F.col("anchor") == F.col("of"), "left_semi")
            .select("anchor", "print")
            .repartition("anchor")
            .sortWithinPartitions("anchor", "print")
            .mapInArrow(_compared(bits), "a long, b long")
            .distinct()
        )
        links = stored(found, f"anchor-links-{level}") if links is None else links.union(stored(found, f"anchor-links-{level}"))
        more = sizes.filter(F.col("n") > crowded)
        if last or more.isEmpty():
            return links
        members = members.join(small_side(more.select("of")), F.col("anchor") == F.col("of"), "left_semi")
        level += 1


def simhash_duplicates(
    docs: DataFrame,
    k: int = 5,
    bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """Per document its 64-bit SimHash fingerprint and the smallest id among those linked with it.

    Words are runs of anything but space and 0x09 to 0x0D with A-Z lower-cased. A shingle
    is k words joined by a space, the whole sequence of a shorter text; repeats count. A
    bit is 1 if over half of the shingles' XXH64 (seed 42) have it. Fingerprints at most ``bits``
    apart are linked, and components of links share ``component_id``.

    Equal fingerprints are one node from the start, so copies meet nobody. Nodes are dealt to the
    anchors of a covering code (``block_anchors``) and compared per anchor; a bucket hands on the pairs
    that join its classes and not all its links.

    Null and empty texts have fingerprint 0, linked like any other. Rows without an id are
    linked as well; ``component_id`` is the smallest id there is, null if there is none.
    Rows that repeat an id each keep their own fingerprint. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = stored(read.mapInArrow(_fingerprints(k), "id long, print long"), "fingerprints")
    nodes = stored(prints.groupBy("print").agg(F.min("id").alias("least_id")), "fingerprint-nodes")
    roots = connected_components(anchored_links(nodes, bits, crowded)).withColumnRenamed("node", "of")
    rooted = nodes.join(roots, F.col("print") == F.col("of"), "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(rooted, "fingerprint-roots")
    least = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least_id").alias("component_id"))
    of_print = stored(
        rooted.join(least, F.col("root") == F.col("of")).select(F.col("print").alias("same"), "component_id"),
        "fingerprint-components",
    )
    return prints.join(of_print, F.col("print") == F.col("same")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
