"""What each of several quality filters removes, in every order: path counts over the lattice of filter sets."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

#: A filter says whether a document fails, from its text and its words.
Filter = Callable[[Column, Column], Column]

MOST_FILTERS = 7  # every order is reported, so there are as many as its factorial
NULL_SALTS = 256  # parts that rows without an id are spread over


def fewer_words(least: int) -> Filter:
    """Fails texts of under ``least`` words."""
    return lambda text, words: F.size(words) < least


def repetitive(percent: int) -> Filter:
    """Fails texts whose distinct words are under ``percent`` of their words."""
    return lambda text, words: 100 * F.size(F.array_distinct(words)).cast("long") < percent * F.size(words).cast("long")


def capitals(percent: int) -> Filter:
    """Fails texts with more than ``percent`` of their code points in A-Z."""
    return lambda text, words: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > percent * F.length(
        text
    ).cast("long")


def holds_any(characters: str) -> Filter:
    """Fails texts with any of these characters."""
    return lambda text, words: F.rlike(text, F.lit("[" + "".join("\\" + c for c in characters) + "]"))


def repeated_text(text: Column, words: Column) -> Column:
    """Stands for the filter that fails texts which a smaller id holds too; it is judged over the whole table."""
    raise TypeError("judged over the whole table, not from one row")


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """For every set of applied filters, the number of orders that lead to it and that lead on from it to all.

    A set is a bit mask. Both counts are sums over the neighbouring sets, walked
    forward from the empty set and backward from the full one.
    """
    states = 1 << filters
    into, onward = [0] * states, [0] * states
    into[0] = onward[-1] = 1
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                into[state | 1 << f] += into[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if state >> f & 1:
                onward[state & ~(1 << f)] += onward[state]
    return into, onward


def failure_cells(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Filter],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Documents counted by part and set of failed filters: part, mask, n, good, toxic.

    Texts are read once; what goes on is a digest, the id, the part and the mask. Of
    ``repeated_text`` the smallest id of every text found more than once is joined
    back by the SHA-256 of the text; a hot text is merged in each task before, and its
    rows are an ordinary skewed join that adaptive execution splits.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    own = [(i, rule) for i, rule in enumerate(filters.values()) if rule is not repeated_text]
    mask = F.lit(0)
    for i, rule in own:
        mask = mask + F.when(rule(text, words), 1 << i).otherwise(0)
    facts = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("text"),
    ).select("id", "part", mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    facts = stored(facts, "filter-facts")
    table_wide = [i for i, rule in enumerate(filters.values()) if rule is repeated_text]
    if table_wide:
        firsts = (
            facts.groupBy(F.col("digest").alias("of"))
            .agg(F.min("id").alias("first"), F.count("*").alias("rows"))
            .filter("rows > 1 AND first IS NOT NULL")
            .select("of", "first")
        )
        bit = sum(1 << i for i in table_wide)
        facts = facts.join(firsts, F.col("digest") == F.col("of"), "left").withColumn(
            "mask", F.col("mask") + F.when(F.col("id") > F.col("first"), bit).otherwise(0)
        )
    known = labels.groupBy(F.col(id_col).cast("long").alias("labelled")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    ).filter("labelled IS NOT NULL")
    # Rows without an id match no label; a second key keeps them from one partition.
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(NULL_SALTS))).otherwise(0)
    facts = facts.withColumn("salt", salt)
    known = known.withColumn("no_salt", F.lit(0).cast("long"))
    same = (F.col("id") == F.col("labelled")) & (F.col("salt") == F.col("no_salt"))
    return (
        facts.join(known, same, "left")
        .groupBy("part", "mask")
        .agg(F.count("*").alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic"))
    )


def lattice_edges(cells: DataFrame, names: list[str]) -> DataFrame:
    """One row per part and edge of the lattice: a set of filters applied, and one filter applied after them.

    ``kept`` are the documents left afterwards, ``removed`` those that this edge takes (the
    difference of what its two ends keep), ``good_lost`` and ``toxic_lost`` the labelled ones among
    them, ``redundant`` those that fail the filter but were gone, ``unique_fails`` those that
    fail no other filter, and ``orders`` the number of orders that use the edge.
    """
    into, onward = path_counts(len(names))
    full = (1 << len(names)) - 1
    # A document outlives a set of filters if it fails none of them.
    counts = [
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("state")) == 0, F.col(c)).otherwise(0)).alias(c)
        for c in ("n", "good", "toxic")
    ]
    left = (
        cells.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(full))))
        .groupBy("part", "state")
        .agg(*counts)
        .groupBy("part")  # one row per state: as many as sets of filters
        .agg(F.map_from_entries(F.collect_list(F.struct("state", F.struct("n", "good", "toxic")))).alias("left"))
    )
    edges = [
        F.struct(
            F.lit(state).alias("state"),
            F.lit(state | 1 << f).alias("after"),
            F.lit(1 << f).alias("bit"),
            F.lit(name).alias("filter"),
            F.lit(into[state] * onward[state | 1 << f]).cast("long").alias("orders"),
        )
        for state, (f, name) in itertools.product(range(full + 1), enumerate(names))
        if not state >> f & 1
    ]

    def at(state: Column, count: str) -> Column:
        return F.element_at("left", state)[count]

    state, after, bit = F.col("state"), F.col("after"), F.col("bit")
    removed = at(state, "n") - at(after, "n")
    return left.select("part", "left", F.inline(F.array(*edges))).select(
        "part",
        "state",
        "filter",
        "orders",
        at(after, "n").alias("kept"),
        removed.alias("removed"),
        (at(F.lit(0), "n") - at(bit, "n") - removed).alias("redundant"),
        (at(F.lit(full) - bit, "n") - at(F.lit(full), "n")).alias("unique_fails"),
        (at(state, "good") - at(after, "good")).alias("good_lost"),
        (at(state, "toxic") - at(after, "toxic")).alias("toxic_lost"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Filter],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """What every filter does at every step of every order, per part of the documents.

    ``filters`` maps one-letter names to filters that say which documents fail. A row is
    a part, an order of all filters (their names in a row) and a step of it:
    the columns of ``lattice_edges``, and ``shapley``, what the step's filter removes
    summed over all orders. All rows come from the same edges; an order walks
    one edge per step, so documents are counted once per set of failed filters and
    never once per order.

    A null text is empty; a null part is the empty string. A document without an id
    has no smaller id and no label; rows that repeat an id and text do not fail each other.
    A document labelled more than once is good, or toxic, if any of its labels says so.
    Empty tables give no rows. Other columns are not read.
    """
    names = list(filters)
    if not 1 <= len(names) <= MOST_FILTERS or any(len(name) != 1 for name in names):
        raise ValueError(f"give 1 to {MOST_FILTERS} filters with names of one letter")
    spark = docs.sparkSession
    cells = stored(failure_cells(docs, labels, filters, id_col, text_col, part_col), "filter-cells")
    edges = lattice_edges(cells, names)
    shares = edges.groupBy(F.col("part").alias("of_part"), F.col("filter").alias("of_filter")).agg(
        F.sum(F.col("orders") * F.col("removed")).alias("shapley")
    )
    edges = edges.join(shares, (F.col("part") == F.col("of_part")) & (F.col("filter") == F.col("of_filter")))
    steps = []
    for order in itertools.permutations(names):
        state = 0
        for step, name in enumerate(order, start=1):
            steps.append(("".join(order), step, state, name))
            state |= 1 << names.index(name)
    # As many rows as the filters have orders and steps, whatever the documents.
    walked = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, at_state int, at_filter string"))
    return edges.join(
        walked, (F.col("state") == F.col("at_state")) & (F.col("filter") == F.col("at_filter"))
    ).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
