"""Phrase collocations: a sample proposes phrases, full passes count them and their negative border."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, small_side, stored

UNKNOWN = "und"
FILTER_BITS = 25  # log2 of the bits of a phrase filter: what the driver and every worker hold
HELD = 1 << 20  # phrases that a task merges before it hands them on
BLOCK_BYTES = 1 << 20

#: Bytes that end a piece of text, and the two that part words inside a piece.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True

COUNTS = "lang string, size int, phrase string, n long"
#: What tasks hand on: phrase and language in one text, parted by a mark that no phrase holds.
KEYED = "key string, n long"
MARK = "\n"


class PhraseFilter:
    """A set of phrases of one length as a bit table of fixed size: it may hold more than was put in, never less.

    What is held too much is counted for nothing; results stay exact.
    """

    def __init__(self, log_bits: int, slots: np.ndarray, bits: np.ndarray):
        self.log_bits = log_bits
        self.table = np.zeros(1 << log_bits - 6, np.uint64)
        self.table[slots] = bits

    def __getstate__(self) -> tuple:
        """What travels to the workers: the slots that are in use."""
        slots = np.flatnonzero(self.table)
        return self.log_bits, slots.astype(np.int32), self.table[slots]

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in places_of(hashes, self.log_bits):
            found &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def places_of(hashes: np.ndarray, log_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter that stand for each hash."""
    low = np.uint64((1 << log_bits) - 1)
    return hashes & low, (hashes >> np.uint64(64 - log_bits)) & low


#: The filters of one pass by phrase length; a length without one holds nothing.
Filters = dict[int, PhraseFilter]


def lang_salt(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


class Pieces:
    """The words of a block of whole pieces: hashes that depend on the language, and where phrases fit."""

    def __init__(self, data: np.ndarray, places: np.ndarray, salts: np.ndarray):
        """``data`` has one blank between words; ``salts`` is the language's number per piece."""
        words = K.Words(data, places, ~(ENDS_PIECE | BLANK))
        self.starts, self.ends, self.sums = words.starts, words.ends, words.sums
        self.piece = words.owner
        self.salt = salts[self.piece]
        self.last = words.first[1:][self.piece] if len(self.piece) else np.zeros(0, np.int64)

    def fits(self, size: int) -> np.ndarray:
        return np.arange(len(self.last)) + size <= self.last

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return K.mix(K.span_hashes(self.sums, at, at + size) ^ self.salt[at])

    def border(self, passes: Sequence[Filters], longest: int) -> dict[int, np.ndarray]:
        """Where phrases of each length begin that the last pass counts.

        A pass counts a phrase if its filters hold both phrases that are one word shorter, which takes in what
        they hold themselves (the proposed) and what they just don't (the negative border), unless an
        earlier pass has counted it. After the first pass, what is being counted is taken as held too: nobody
        knows yet whether it is frequent, and so its longer phrases need no pass of their own.
        """
        found, counted = {}, {}
        for number, filters in enumerate(passes):
            open_ = filters[1].holds(self.hashes(np.arange(len(self.last)), 1)) if 1 in filters else np.zeros(len(self.last), bool)
            for size in range(2, longest + 1):
                here = np.zeros(len(self.last), bool)
                here[:-1] = open_[:-1] & open_[1:]
                here &= self.fits(size)
                new = here & ~counted[size] if size in counted else here
                counted[size] = here | counted[size] if size in counted else here
                if number == len(passes) - 1:
                    found[size] = np.flatnonzero(new)
                open_ = new.copy() if number else np.zeros(len(self.last), bool)
                if size in filters:
                    at = np.flatnonzero(here & ~open_)
                    open_[at] = filters[size].holds(self.hashes(at, size))
        return found


def one_blank(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes in which a run of blanks is one space, and the places in them."""
    blank = BLANK[data]
    kept = np.ones(len(data), bool)
    kept[1:] = ~(blank[1:] & blank[:-1])
    out = np.where(blank, np.uint8(0x20), K.LOWER[data])[kept]
    return out, np.concatenate([[0], np.cumsum(kept)])[places]


def texts_between(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of many spans as one column."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    gathered = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(gathered)]
    )


def _equal(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal hashes are neighbours, and where runs of them begin.

    Sorts single numbers, which is quicker than sorting an index: the high bits of each hash
    with its place below. Runs compare whole hashes. Different ones that agree in the high
    bits may part a run in two, which adds a row for Spark to merge and no error.
    """
    low = len(hashes).bit_length()
    mask = np.uint64((1 << low) - 1)
    packed = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    order = (packed & mask).astype(np.int64)
    return order, K.runs(hashes[order])


class _Held:
    """Counts of phrases in a task, merged by their hash before they are handed on."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.words: dict[int, int] = {}
        self.parts: list[tuple] = []
        self.rows = 0

    def code(self, lang: str) -> int:
        return self.langs.setdefault(lang, len(self.langs))

    def add(self, hashes: np.ndarray, codes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        order, cuts = _equal(hashes)
        first = order[cuts[:-1]]
        texts = texts_between(data, starts[first], ends[first])
        self.parts.append((hashes[first], np.diff(cuts), codes[first], texts))
        self.rows += len(first)

    def drain(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        hashes, counts, codes = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        texts = pa.chunked_array([p[3] for p in self.parts])
        self.parts, self.rows = [], 0
        # Lengths are told apart by their hashes as well: a phrase of k words hashes as k words.
        order, cuts = _equal(hashes)
        first, sums = order[cuts[:-1]], np.add.reduceat(counts[order], cuts[:-1])
        yield self._batch(codes[first], texts.take(pa.array(first)).combine_chunks(), sums)

    def totals(self) -> Iterator[pa.RecordBatch]:
        """Words per language, as phrases of no words."""
        if self.words:
            codes = np.array(list(self.words), np.int64)
            none = pa.array([""] * len(codes), pa.large_string())
            yield self._batch(codes, none, np.array(list(self.words.values()), np.int64))

    def _batch(self, codes: np.ndarray, texts: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        names = pa.array(list(self.langs), pa.large_string())
        keys = pc.binary_join_element_wise(texts, names.take(pa.array(codes)), pa.scalar(MARK, pa.large_string()))
        return pa.RecordBatch.from_pydict({"key": keys.cast(pa.string()), "n": pa.array(counts, pa.int64())})


def _counts(passes: Broadcast, longest: int, words: bool, sizes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the phrases that the last of ``passes`` counts; with ``words``, of all single words and their total."""

    def run(batches):
        filters, held = passes.value, _Held()
        for batch in K.slices(batches):
            data, texts = K.text_bytes(batch.column("text"))
            codes = np.array([held.code(lang) for lang in batch.column("lang").to_pylist()], np.int64)
            salts = np.array([lang_salt(lang) for lang in held.langs], np.uint64)
            # A piece begins with a text or with the mark that ends the piece before.
            begins = ENDS_PIECE[data]
            begins[texts[:-1][texts[:-1] < len(data)]] = True
            places = np.append(np.flatnonzero(begins), len(data))
            of_piece = codes[np.searchsorted(texts, places[:-1], "right") - 1]
            for i, j in K.blocks(places, BLOCK_BYTES):
                block, at = one_blank(data[places[i] : places[j]], places[i : j + 1] - places[i])
                pieces = Pieces(block, at, salts[of_piece[i:j]])
                code = of_piece[i:j][pieces.piece]
                wanted = pieces.border(filters, longest)
                if words:
                    wanted[1] = np.arange(len(code))
                    for c, n in zip(*np.unique(code, return_counts=True)):
                        held.words[int(c)] = held.words.get(int(c), 0) + int(n)
                for size, first in wanted.items():
                    if size in sizes and len(first):
                        held.add(pieces.hashes(first, size), code[first], block, pieces.starts[first], pieces.ends[first + size - 1])
                if held.rows >= HELD:
                    yield from held.drain()
        yield from held.drain()
        if words:
            yield from held.totals()

    return run


@contextmanager
def _shared(spark: SparkSession, passes: Sequence[Filters]) -> Iterator[Broadcast]:
    """Filters for the tasks of what is run inside; their copies on disk go afterwards."""
    held = spark.sparkContext.broadcast(list(passes))
    try:
        yield held
    finally:
        held.destroy()


def count_phrases(
    docs: DataFrame, passes: Broadcast, longest: int, least: int, *, words: bool, sizes: Sequence[int]
) -> DataFrame:
    """Exact counts over all of ``docs`` (lang, text) of what a pass with these filters counts, from ``least`` on.

    Tasks have merged equal phrases when they hand them on, so they are dealt out as they are;
    merging them in the JVM once more before the shuffle costs more than it saves.
    """
    counts = (
        docs.mapInArrow(_counts(passes, longest, words, sizes), KEYED)
        .repartition("key")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) | F.col("key").startswith(MARK))
        .withColumn("phrase", F.substring_index("key", MARK, 1))
    )
    blanks = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    return counts.select(
        F.expr("substring(key, length(phrase) + 2)").alias("lang"),
        F.when(F.col("phrase") == "", 0).otherwise(blanks + 1).alias("size"),
        "phrase",
        "n",
    )


def _phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """Hashes of whole phrases of one length, as the passes hash them."""
    data, places = K.text_bytes(batch.column("phrase"))
    salts = np.array([lang_salt(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
    words = K.Words(data, places, ~(ENDS_PIECE | BLANK))
    return K.mix(K.span_hashes(words.sums, words.first[:-1], words.first[1:]) ^ salts)


def _filter_slots(log_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("size").to_numpy()
            hashes = _phrase_hashes(batch)
            for size in np.unique(sizes):
                at = np.unique(np.concatenate(places_of(hashes[sizes == size], log_bits)))
                slots = at >> np.uint64(6)
                cuts = K.runs(slots)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), cuts[:-1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "size": pa.array(np.full(len(bits), size, np.int32)),
                        "slot": pa.array(slots[cuts[:-1]].astype(np.int32)),
                        "bits": pa.array(bits.view(np.int64)),
                    }
                )

    return run


def phrase_filters(frequent: DataFrame, log_bits: int) -> Filters:
    """A filter per phrase length of a table of phrases; at most 2^log_bits bits of each come to the driver."""
    slots = (
        frequent.select("lang", "size", "phrase")
        .mapInArrow(_filter_slots(log_bits), "size int, slot int, bits long")
        .groupBy("size", "slot")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    sizes, at, bits = (slots.column(c).to_numpy() for c in ("size", "slot", "bits"))
    return {
        int(size): PhraseFilter(log_bits, at[sizes == size], bits[sizes == size].view(np.uint64)) for size in np.unique(sizes)
    }


def _outside(passes: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Phrases that the last pass's filters do not hold: what it has not looked beyond."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, hashes = batch.column("size").to_numpy(), _phrase_hashes(batch)
            inside = np.zeros(len(hashes), bool)
            for size, held in passes.value[-1].items():
                inside[sizes == size] = held.holds(hashes[sizes == size])
            yield batch.filter(pa.array(~inside))

    return run


def frequent_phrases(
    docs: DataFrame,
    min_count: int = 10,
    longest: int = 3,
    sample: float = 0.1,
    log_bits: int = FILTER_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> tuple[DataFrame, int]:
    """Exact counts of all phrases of 1 to ``longest`` words that occur ``min_count`` times in a language.

    Toivonen's method. Level by level, a sample of the documents (a hash of id and text
    below ``sample``) proposes the phrases that reach the lowered count ``max(2, half of sample *
    min_count)`` in it. A pass over all documents counts the proposed phrases and
    their negative border: all phrases whose parts of one word less are both proposed. A
    border phrase (or word) that is frequent in the whole has longer phrases which nobody
    has counted: then a further pass counts the border of all frequent phrases known by then, less
    what is counted, and takes in the longer phrases of what it counts itself, which
    closes the search. The result does not depend on the sample.

    Proposed phrases travel as filters of 2^log_bits bits per length, whatever their number; a
    full filter costs needless counts and no result. Returns lang, size, phrase, n (size 0 holds
    the words of a language) and the number of passes over all documents.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    read = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    drawn = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 20)) < int(sample * (1 << 20))
    part = docs.filter(drawn).select(lang.alias("lang"), F.col(text_col).alias("text"))
    lowered = max(2, int(sample * min_count / 2))
    proposed: Filters = {}
    for size in range(1, longest):
        with _shared(spark, [proposed]) as shared:
            counts = count_phrases(part, shared, size, lowered, words=size == 1, sizes=[size])
            proposed |= phrase_filters(counts.filter(F.col("size") == size), log_bits)
    passes, tables = [proposed], []
    while True:
        first = len(passes) == 1
        with _shared(spark, passes) as shared:
            sizes = range(1 if first else 2, longest + 1)
            tables.append(stored(count_phrases(read, shared, longest, min_count, words=first, sizes=sizes), "phrase-counts"))
            known = reduce(DataFrame.union, tables)
            inner = known.filter((F.col("size") > 0) & (F.col("size") < longest))
            # A further pass looks beyond all that it counts.
            if not first or inner.mapInArrow(_outside(shared), COUNTS).isEmpty():
                return known, len(passes)
        passes.append(phrase_filters(inner, log_bits))


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def _counts_named(frequent: DataFrame, phrase: str, count: str) -> DataFrame:
    return frequent.select(F.col("lang").alias(f"{phrase}_lang"), F.col("phrase").alias(phrase), F.col("n").alias(count))


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    longest: int = 3,
    swallowed: int = 50,
    top: int | None = None,
    sample: float = 0.1,
    log_bits: int = FILTER_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Phrases whose words occur together, per language, the strongest first.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and 0x0A to 0x0D and into words at blanks
    and tabs. Candidates are phrases of 2 to ``longest`` words found ``min_count`` times or more inside
    pieces, overlaps included. A cut into two parts found l and r times scores a candidate found a
    times as floor(1000000 * a * a / (l * r)), in decimals of 38 digits (exact up to a = 10^15); the lowest
    cut counts, of equal ones the first. A candidate inside a longer one that has ``swallowed`` percent of its
    occurrences or more is dropped. ``rank`` orders what is left by score and a (descending) and
    phrase (in bytes); ``top`` keeps the first so many of each language. ``n`` is the words of the language.

    A null language is ``und``, a null text empty. Repeated rows count again; null and repeated ids
    matter only to the sample. A table without phrases gives no rows. Other columns are not read.
    """
    frequent, _ = frequent_phrases(docs, min_count, longest, sample, log_bits, id_col, text_col, lang_col)
    counted = frequent.filter("size > 0")
    candidates = frequent.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    candidates = candidates.withColumn("words", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "size", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail")
    )
    cuts = cuts.join(
        small_side(_counts_named(counted, "left", "l")), (F.col("lang") == F.col("left_lang")) & (F.col("head") == F.col("left"))
    ).join(
        small_side(_counts_named(counted, "right", "r")), (F.col("lang") == F.col("right_lang")) & (F.col("tail") == F.col("right"))
    )
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumn("above", F.lit(1000000).cast("decimal(7,0)") * (wide["a"] * wide["a"])).withColumn(
        "below", wide["l"] * wide["r"]
    )
    scored = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("lowest")
    )
    inside = (
        candidates.filter("size > 2")
        .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
        .groupBy(F.col("lang").alias("in_lang"), _part(F.col("start"), F.col("length")).alias("inner"))
        .agg(F.max("a").alias("around"))
    )
    swallows = 100 * F.coalesce("around", F.lit(0)) >= swallowed * F.col("a")
    left = scored.join(
        inside, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left"
    ).filter(~swallows)
    order = W.partitionBy("lang").orderBy(F.desc("lowest.score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    totals = frequent.filter("size = 0").select(F.col("lang").alias("of_lang"), F.col("n").alias("n"))
    return ranked.join(small_side(totals), F.col("lang") == F.col("of_lang")).select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("lowest.l").alias("l"),
        F.col("lowest.r").alias("r"),
        "n",
        F.col("lowest.score").alias("score"),
    )
