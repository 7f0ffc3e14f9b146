"""SimHash near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from plumbline.llm import simhash
from plumbline.llm.simhash import anchored_links, block_anchors, fingerprint, simhash_duplicates

SCHEMA = "doc_id long, text string, print string, anchor int, home int, fingerprint int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    """The smallest of each print's class, by all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[i + 1 :]:
            if (p ^ q).bit_count() <= bits:
                a, b = sorted((find(p), find(q)))
                root[b] = a
    return {p: find(p) for p in prints}


def compare(spark, rows, k=3, bits=3, crowded=simhash.CROWDED):
    docs = spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in rows], SCHEMA)
    found = simhash_duplicates(docs, k, bits, crowded=crowded).collect()
    prints = [plain_print(t, k) for _, t in rows]
    root = classes(prints, bits)
    least = {}
    for (doc, _), p in zip(rows, prints):
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    wanted = sorted(((d, f"{p:016x}", least.get(root[p])) for (d, _), p in zip(rows, prints)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=repr) == wanted


def test_equals_all_pairs(spark):
    """Copies, near copies, nulls, empty and long texts, odd white space, rows repeated in full."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [rng.choice(["the", "Of", "schön", "É"]) + str(rng.randrange(40)) for _ in range(rng.choice([1, 2, 3, 4, 60, 200]))]
        rows.append((i, rng.choice([" ", "\t\n", "  "]).join(words)))
        for j in range(rng.choice([0, 0, 1, 3])):
            close = list(words)
            close[rng.randrange(len(close))] = "other"
            rows.append((1000 + 10 * i + j, " ".join(close)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, None), (None, rows[5][1]), (None, "only here")]
    rows += [(300 + i, "the same text again and again") for i in range(50)] + [rows[0], rows[0], (0, "x y z")]
    rows += [(400, "a b\x00c " * 3), (401, "w" * 5000), (402, " ".join(f"w{i % 977}" for i in range(400_000)))]
    rng.shuffle(rows)
    compare(spark, rows)
    compare(spark, rows, k=5, bits=1)


def test_empty_table(spark):
    assert simhash_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_text_in_runs(monkeypatch):
    text = " ".join(f"w{i % 31}" for i in range(300)) + "\n" + "y" * 40
    whole = fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "RUN_BYTES", 16)
    assert fingerprint(text.encode(), 3) == whole
    assert whole & (1 << 64) - 1 == plain_print(text, 3)


@pytest.mark.parametrize("width", [4, 8, 16, 32])
def test_anchors_cover(width):
    """Blocks at most one bit apart meet: each is dealt to the other's own anchor."""
    rng = np.random.default_rng(width)
    x = rng.integers(0, 1 << width, 300, dtype=np.uint64)
    own, _ = block_anchors(x, width)
    for b in range(width):
        words, there = block_anchors(x ^ np.uint64(1 << b), width)
        assert ((words == own[:, :1]) & there).any(1).all()
    low = np.uint64((1 << width - 1) - 1)
    assert (np.bitwise_count((own[:, 0] ^ x) & low) <= 1).all() and ((own[:, 0] ^ x) <= low).all()


def links_give(spark, prints, bits, crowded):
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    found = anchored_links(spark.createDataFrame(signed, "print long").distinct(), bits, crowded).distinct().collect()
    mask = (1 << 64) - 1
    wanted = classes(prints, bits)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in ((r.a & mask, r.b & mask) for r in found):
        assert wanted[a] == wanted[b]
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {p: find(p) for p in prints} == wanted
    return found


@pytest.mark.parametrize("crowded", [3, 40, simhash.CROWDED])
def test_hot_anchors_are_split(spark, crowded):
    """A dense ball, a half shared by all of a third, and noise: all links, at every level of splitting."""
    rng = random.Random(crowded)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(300):
        p = centre
        for _ in range(rng.randrange(9)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints |= {centre & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(200)}
    for base in [rng.getrandbits(64) for _ in range(60)]:
        prints |= {base, base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), base ^ 0b1011 << rng.randrange(60)}
    found = links_give(spark, sorted(prints), 3, crowded)
    assert len(found) < 40 * len(prints)


def test_a_large_class_gives_few_pairs(spark):
    """All fingerprints within one bit of a centre or two: over 2,000 nodes, and not all their links."""
    centre = random.Random(1).getrandbits(64)
    prints = {centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)}
    found = links_give(spark, sorted(prints), 3, simhash.CROWDED)
    assert len(found) < 34 * len(prints)
