"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate links."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, small_side, stored

BANDS = 64
ROWS = 6
SEED = 29
BITS = 2  # kept of every bin for estimates
DEVIATIONS = 6  # of an estimate below the threshold before a pair is left out


def _probe_order(bins: int) -> np.ndarray:
    """For every bin the order in which an empty one asks the others for a value."""
    rng = np.random.default_rng(SEED)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def shingle_sets(words: K.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and where each set begins."""
    hashes, at = words.grams(k)
    owner = words.owner[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))  # their whole sequence is one shingle
    if len(short):
        whole = K.span_hashes(words.sums, words.first[short], words.first[short + 1])
        hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(words.counts) + 1))
    sets = [np.unique(hashes[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum(sizes)])


def signatures(values: np.ndarray, places: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """One-permutation MinHash: per bin the smallest hash, empty bins filled from the first filled one asked."""
    n = len(places) - 1
    out = np.zeros((n, bins), np.uint64)
    filled = np.zeros((n, bins), bool)
    owner = np.repeat(np.arange(n), np.diff(places))
    fresh = K.mix(values.copy())  # the set's order must not decide the bins
    bin_of = (fresh % np.uint64(bins)).astype(np.int64)
    cell = owner * bins + bin_of
    order = np.lexsort((fresh, cell))
    first = order[K.runs(cell[order])[:-1]]
    out.reshape(-1)[cell[first]] = fresh[first]
    filled.reshape(-1)[cell[first]] = True
    some = filled.any(1)
    doc, hole = np.nonzero(~filled & some[:, None])
    for step in range(bins):
        if not len(doc):
            break
        donor = probes[hole, step]
        ok = filled[doc, donor]
        out[doc[ok], hole[ok]] = out[doc[ok], donor[ok]]
        doc, hole = doc[~ok], hole[~ok]
    return out


def estimate_bits(signature: np.ndarray) -> np.ndarray:
    """A few bits of every bin as 64-bit integers: two documents agree in all of a bin's bits if they agree in the bin."""
    low = (K.mix(signature.copy())[:, :, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    packed = np.packbits(low.astype(np.uint8).reshape(len(signature), -1), axis=1)
    whole = np.zeros((len(signature), -(-packed.shape[1] // 8) * 8), np.uint8)
    whole[:, : packed.shape[1]] = packed
    return whole.view(np.int64)


def _bit_columns(bands: int, rows: int) -> list[str]:
    return [f"bits{i}" for i in range(-(-bands * rows * BITS // 64))]


def _sketch(k: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        probes = _probe_order(bands * rows)
        band_salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(K.BASE)
        for batch in batches:
            data, places = K.text_bytes(batch.column("text"))
            for i, j in K.blocks(places):
                low = K.LOWER[data[places[i] : places[j]]]
                words = K.Words(low, places[i : j + 1] - places[i], K.NOT_SPACE)
                values, cuts = shingle_sets(words, k)
                sizes = np.diff(cuts)
                signature = signatures(values, cuts, bands * rows, probes)
                bits = estimate_bits(signature)
                signature = signature.reshape(j - i, bands, rows)
                band = np.zeros((j - i, bands), np.uint64) + band_salt
                for r in range(rows):
                    band = K.mix(band * np.uint64(K.BASE) + signature[:, :, r])
                digests = [
                    hashlib.blake2b(values[a:b].tobytes(), digest_size=8).digest() for a, b in zip(cuts[:-1], cuts[1:])
                ]
                nodes = np.frombuffer(b"".join(digests), np.int64)
                at = np.arange(0, (j - i) * bands + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id").slice(i, j - i),
                        "mark": batch.column("mark").slice(i, j - i),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "node": pa.array(nodes, pa.int64()),
                        "bands": pa.ListArray.from_arrays(pa.array(at), pa.array(band.reshape(-1).view(np.int64))),
                    }
                    | {name: pa.array(bits[:, b]) for b, name in enumerate(_bit_columns(bands, rows))}
                )

    return run


def _sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            data, places = K.text_bytes(batch.column("text"))
            for i, j in K.blocks(places):
                low = K.LOWER[data[places[i] : places[j]]]
                words = K.Words(low, places[i : j + 1] - places[i], K.NOT_SPACE)
                values, cuts = shingle_sets(words, k)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": batch.column("node").slice(i, j - i),
                        "shingles": pa.ListArray.from_arrays(
                            pa.array(cuts.astype(np.int32)), pa.array(values.view(np.int64))
                        ),
                    }
                )

    return run


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is the smallest node reachable.

    Each round a node takes the smallest of its neighbours' roots and its root's root, until nothing
    changes. A round is one written table.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("root")
    )
    roots = stored(roots, "roots")
    while True:
        root_of = roots.select(F.col("node").alias("of"), F.col("root").alias("near"))
        none = F.lit(None).cast("long")
        heard = (
            both.join(root_of, F.col("b") == F.col("of"))
            .select(F.col("a").alias("node"), "near", none.alias("own"))
            .union(roots.join(root_of, F.col("root") == F.col("of")).select("node", "near", F.col("root").alias("own")))
        )
        rounds = heard.groupBy("node").agg(F.min("near").alias("root"), F.max("own").alias("before"))
        rounds = stored(rounds, "roots")
        roots = rounds.select("node", "root")
        if rounds.filter("root != before").isEmpty():
            return roots


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """How many shingles the full sets of each pair share."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return (
        pairs.join(b, "b")
        .join(a, "a")
        .select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).cast("long").alias("both"))
    )


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.filter(100 * F.col("shared") >= percent * (F.col("both") - F.col("shared"))).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    marked: bool = False,
) -> DataFrame:
    """Per document the number of its shingles and the smallest id among its near duplicates.

    Words are runs of anything but space and 0x09 to 0x0D with A-Z lower-cased; a
    document's set holds its distinct shingles of k words, or its whole sequence
    if it is shorter. Documents with 100 * shared >= percent * union are linked,
    and components of links share ``component_id``.

    Documents with equal sets are one node from the start. A node's set is hashed once
    into bands * rows bins (one-permutation MinHash with densification); at 80 % the
    chance that no band of a pair agrees is 0.738^64 = 4e-9. In each bucket all nodes
    are candidates of one centre, the node that meets the most others in all its
    buckets: a star, so candidates grow with the bucket and not its square.
    Candidates are confirmed on the full sets. Nodes of one bucket that are still in
    different components after that are compared too, so that no link is lost to a
    centre that lies too far off, unless their sizes and what they share with the
    centre, or an estimate from all bins, rule a link out. Those pairs can grow faster
    than the bucket where many of its nodes are far from the centre yet near each other.

    Null and empty texts have empty sets: never linked. Null ids are not linked
    either, and their component_id is null. Rows that share an id each go by their own
    text; ``marked`` adds ``mark``, its xxhash64, which tells them apart. Other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    read = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    bits = _bit_columns(bands, rows)
    sketched = stored(
        read.mapInArrow(
            K.tidy(_sketch(k, bands, rows)),
            "id long, mark long, n_shingles long, node long, bands array<long>, "
            + ", ".join(f"{name} long" for name in bits),
        ),
        "sketches",
    )
    linkable = sketched.filter("id IS NOT NULL AND n_shingles > 0")
    nodes = stored(
        linkable.groupBy("node").agg(
            F.min("id").alias("least_id"), F.first("n_shingles").alias("n"), *[F.first(b).alias(b) for b in bits]
        ),
        "nodes",
    )
    chosen = (
        linkable.join(nodes, (linkable.node == nodes.node) & (linkable.id == nodes.least_id), "left_semi")
        .dropDuplicates(["node"])
    )
    buckets = chosen.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(buckets.join(sizes, "band"), "bucket-members")
    members = stored(_with_centres(members), "bucket-centres")
    fits = 100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")
    star_pairs = stored(
        members.filter(F.col("node") != F.col("centre"))
        .filter(fits)
        .select(F.col("centre").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "star-pairs",
    )
    needed = members.select("node").distinct().join(nodes.select("node", "least_id"), "node")
    sources = (
        linkable.select("id", "mark", F.col("node").alias("of"))
        .join(needed, (F.col("of") == F.col("node")) & (F.col("id") == F.col("least_id")))
        .select("id", "mark", "node")
        .dropDuplicates(["node"])
    )
    sources = stored(sources, "set-sources")
    sets = stored(
        read.join(small_side(sources), ["id", "mark"])
        .select("node", "text")
        .mapInArrow(K.tidy(_sets(k)), "node long, shingles array<long>")
        .dropDuplicates(["node"]),
        "sets",
    )
    compared = stored(_compared(star_pairs, sets), "star-compared")
    links = _linked(compared, percent)
    roots = connected_components(links)
    rest = _across(members, roots, compared, sets, nodes.select("node", *bits), percent, bands * rows)
    more = stored(_linked(_compared(rest, sets), percent), "links-across")
    of_node = nodes.join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    if not more.isEmpty():
        of_node = stored(of_node, "first-roots")
        root_of = of_node.select("node", "root")
        joined = (
            more.join(root_of.toDF("a", "root_a"), "a").join(root_of.toDF("b", "root_b"), "b").select("root_a", "root_b")
        )
        later = connected_components(joined.toDF("a", "b").filter("a != b")).toDF("root", "later")
        of_node = of_node.join(later, "root", "left").select(
            "node", "least_id", F.coalesce("later", "root").alias("root")
        )
    least = of_node.groupBy("root").agg(F.min("least_id").alias("component"))
    of_node = stored(of_node.join(least, "root").select("node", "component"), "components")
    linked = F.col("id").isNotNull() & (F.col("n_shingles") > 0)
    return (
        sketched.withColumn("of", F.when(linked, F.col("node")))
        .drop("node", "bands")
        .join(of_node, F.col("of") == F.col("node"), "left")
        .select(
            F.col("id").alias("doc_id"),
            *(["mark"] if marked else []),
            "n_shingles",
            F.coalesce("component", "id").alias("component_id"),
            F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
        )
    )


def _with_centres(members: DataFrame) -> DataFrame:
    """Each bucket's centre and its set's size: the node that meets most others anywhere."""
    meets = members.groupBy("node").agg(F.sum("size").alias("meets"))
    top = members.join(meets, "node").groupBy("band").agg(F.max(F.struct("meets", "node", "n")).alias("top"))
    return members.join(
        top.select("band", F.col("top.node").alias("centre"), F.col("top.n").alias("centre_n")), "band"
    ).select("band", "node", "n", "centre", "centre_n")


def _across(
    members: DataFrame,
    roots: DataFrame,
    compared: DataFrame,
    sets: DataFrame,
    estimates: DataFrame,
    percent: int,
    bins: int,
) -> DataFrame:
    """Pairs of a bucket that lie in different components, that no star has compared, and that may be linked.

    Only buckets with several components are opened. Two nodes share at most what both share with the
    centre, plus what both have beside it. So they are linked only if what they share with the centre is
    enough by itself, which few nodes' sizes allow without a link to the centre, or if they have a shingle
    in common that the centre lacks: these meet at that shingle. Near copies that each differ from
    the centre in their own way meet nowhere, however many they are. Pairs whose similarity, estimated
    from the bits kept of all bins, lies more than DEVIATIONS standard deviations below the threshold (a
    chance of about 1e-9 for a pair at the threshold) are left out as well.
    """
    known = compared.select(F.col("a").alias("centre"), F.col("b").alias("node"), "shared")
    placed = (
        members.join(roots, "node", "left")
        .join(known, ["centre", "node"], "left")
        .select(
            "band",
            "centre",
            "node",
            "n",
            F.coalesce("root", "node").alias("root"),
            F.when(F.col("node") == F.col("centre"), F.col("n")).otherwise(F.col("shared")).alias("inside"),
        )
    )
    placed = stored(placed, "bucket-components")
    largest = (
        placed.groupBy("band", "root")
        .agg(F.count("*").alias("size"))
        .groupBy("band")
        .agg(F.max(F.struct("size", "root")).alias("top"), F.count("*").alias("components"))
        .filter("components > 1")
        .select("band", F.col("top.root").alias("main"))
    )
    opened = stored(placed.join(largest, "band"), "buckets-opened")
    # Nodes that do not fit the centre in size have not met it yet.
    unmet = opened.filter("inside IS NULL").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    met = _compared(unmet, sets).select(F.col("a").alias("centre"), F.col("b").alias("node"), F.col("shared").alias("met"))
    opened = opened.join(stored(met, "centres-met"), ["centre", "node"], "left").withColumn(
        "inside", F.coalesce("inside", "met")
    )
    opened = stored(opened.drop("met"), "buckets-met")
    share = F.least("inside_x", "inside_y")

    def enough(most: Column) -> Column:
        return 100 * most >= percent * (F.col("n_x") + F.col("n_y") - most)

    def side(rows: DataFrame, x: str, at: list[str]) -> DataFrame:
        return rows.select(*at, *[F.col(c).alias(f"{c}_{x}") for c in rows.columns if c not in at])

    # What is shared with the centre can only be enough for a node that has most of its set there.
    mostly = opened.filter(100 * F.col("inside") >= percent * F.col("n")).drop("centre")
    at = ["band", "main"]
    once = (F.col("root_y") == F.col("main")) | (F.col("node_x") < F.col("node_y"))
    through_centre = (
        side(mostly.filter("root != main"), "x", at)
        .join(side(mostly, "y", at), at)
        .filter((F.col("root_x") != F.col("root_y")) & once & enough(share))
    )
    star = opened.select("centre", "node", "n", "root", "inside").distinct().filter("inside < n")
    of_centre = sets.select(F.col("node").alias("centre"), F.col("shingles").alias("of_centre"))
    own = (
        star.join(sets, "node")
        .join(of_centre, "centre")
        .withColumn("beside", F.sort_array(F.array_except("shingles", "of_centre")))
        .select("*", F.posexplode("beside").alias("place", "shingle"))
        # So many from here on: at the first shingle that two nodes share, they share no more than these.
        .withColumn("after", F.size("beside") - F.col("place"))
        .drop("shingles", "of_centre", "beside", "place")
    )
    own = stored(own, "shingles-beside-centres")
    at = ["centre", "shingle"]
    beside_centre = (
        side(own, "x", at)
        .join(side(own, "y", at), at)
        .filter((F.col("node_x") < F.col("node_y")) & (F.col("root_x") != F.col("root_y")) & enough(share + F.least("after_x", "after_y")))
    )
    pairs = (
        through_centre.select("node_x", "n_x", "node_y", "n_y")
        .union(beside_centre.select("node_x", "n_x", "node_y", "n_y"))
        .select(
            F.least("node_x", "node_y").alias("a"),
            F.greatest("node_x", "node_y").alias("b"),
            F.least("n_x", "n_y").alias("smaller"),
        )
        .distinct()
    )
    tested = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs-possible")
    bits = [c for c in estimates.columns if c != "node"]
    for x in "ab":
        pairs = pairs.join(estimates.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in bits]), x)
    unlike = F.lit(0)
    for c in bits:
        unlike = unlike + F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    # Bits of unequal bins differ in half of the cases.
    estimate = 1 - 2 * unlike / (bins * BITS)
    level = percent / 100
    spread = F.sqrt(level * (1 - level) / F.least(F.lit(bins), "smaller") + (1 - level) / (bins * BITS))
    return stored(pairs.filter(estimate >= level - DEVIATIONS * spread).select("a", "b"), "pairs-across")
