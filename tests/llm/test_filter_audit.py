"""The filter audit against plain simulation of every order."""

from __future__ import annotations

import collections
import itertools
import random
import re

import pytest

from plumbline.llm.catalog import AUDITED
from plumbline.llm.filter_audit import audit_filters, fewer_words, path_counts, repeated_text

DOCS = "doc_id long, text string, source string, mask int, salt int, n int, digest string"
LABELS = "doc_id long, quality int, toxic int, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """The letters each row fails, computed one row at a time."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc is not None and doc > least[text]:
            fails.add("E")
        out.append(fails)
    return out


def simulated(rows, labels):
    fails = failures(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    shapley = collections.Counter()
    for order in itertools.permutations("ABCDE"):
        alive = [True] * len(rows)
        for step, f in enumerate(order, start=1):
            count = collections.defaultdict(collections.Counter)
            for i, (doc, _, source) in enumerate(rows):
                c = count[source or ""]
                if f in fails[i]:
                    c["unique_fails"] += fails[i] == {f}
                    if alive[i]:
                        c["removed"] += 1
                        c["good_lost"] += doc in good
                        c["toxic_lost"] += doc in toxic
                        alive[i] = False
                    else:
                        c["redundant"] += 1
                c["kept"] += alive[i]
            for part, c in count.items():
                out[part, "".join(order), step] = c
                shapley[part, f] += c["removed"]
    for (part, order, step), c in out.items():
        c["shapley"] = shapley[part, order[step - 1]]
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def compare(spark, rows, labels):
    docs = spark.createDataFrame([(*row, 1, 2, 3, "x") for row in rows], DOCS)
    marks = spark.createDataFrame([(*row, "x") for row in labels], LABELS)
    found = audit_filters(docs, marks, AUDITED).collect()
    expected = simulated(rows, labels)
    assert len(found) == len(expected)
    for row in found:
        wanted = expected[row["part"], row["filter_order"], row["step"]]
        assert [row[c] for c in COUNTS] == [wanted[c] for c in COUNTS], row


def test_equals_simulation(spark):
    """Nulls in all columns, empty and long texts, ties, rows repeated in full, labels twice or for nothing."""
    rng = random.Random(3)
    rows = []
    for i in range(160):
        few = rng.random() < 0.3
        words = [rng.choice(["a", "B", "c"]) if few else f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 150, 199, 200, 201, 260]))]
        if rng.random() < 0.2:
            words = [w.upper() for w in words]
        if rng.random() < 0.2:
            words.append(rng.choice("#$%&*|"))
        rows.append((i, rng.choice([" ", "\n", " \t", "  "]).join(words), rng.choice(["x", "y", None, ""])))
    rows += [(500 + i, rows[i % 7][1], "x") for i in range(40)]
    rows += [(None, rows[0][1], "y"), (None, None, None), (None, "", "x"), (0, rows[0][1], "x"), (0, rows[0][1], "x")]
    rows += [(600, None, "x"), (601, "", "x"), (602, " \n", None), (603, "schön ß " * 120, "y"), (604, "Ä" * 300, "y")]
    rows += [(605, "long " * 200_000, "z"), (606, "AB ab " * 2000, "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 610, 3)]
    labels += [(0, 0, 0), (0, 1, None), (None, 1, 1), (None, 1, 1), (99999, 1, 1)]
    compare(spark, rows, labels)


def test_hot_text_and_null_ids(spark):
    rows = [(i, "the same", "hot") for i in range(300)] + [(None, "the same", "hot")] * 200 + [(1000, "x", "cold")]
    compare(spark, rows, [(i, 1, i % 2) for i in range(300)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a", "s", 0, 0, 0, "")], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert audit_filters(none, labels, AUDITED).count() == 0
    assert audit_filters(some, labels, AUDITED).count() == 600


def test_path_counts():
    """Ways in and ways on multiply to the orders that cross a set, and edges of a filter share them all."""
    into, onward = path_counts(5)
    assert into[-1] == onward[0] == 120
    for state in range(32):
        through = sum(1 for order in itertools.permutations(range(5)) for k in range(6) if sum(1 << f for f in order[:k]) == state)
        assert into[state] * onward[state] == through
    for f in range(5):
        assert sum(into[s] * onward[s | 1 << f] for s in range(32) if not s >> f & 1) == 120


def test_other_sets_of_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b", "s"), (3, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    one = audit_filters(docs, labels, {"w": fewer_words(2)}).collect()
    assert [(r["filter_order"], r["kept"], r["removed"], r["shapley"]) for r in one] == [("w", 2, 1, 1)]
    two = audit_filters(docs, labels, {"w": fewer_words(3), "r": repeated_text})
    assert {(r["filter_order"], r["step"]): (r["removed"], r["redundant"]) for r in two.collect()} == {
        ("wr", 1): (3, 0), ("wr", 2): (0, 1), ("rw", 1): (1, 0), ("rw", 2): (2, 1)
    }
    with pytest.raises(ValueError):
        audit_filters(docs, labels, {})
    with pytest.raises(ValueError):
        audit_filters(docs, labels, {"ab": fewer_words(2)})
