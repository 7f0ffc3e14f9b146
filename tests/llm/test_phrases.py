"""Phrase collocations against plain counting."""

from __future__ import annotations

import collections
import pickle
import random
import re

import numpy as np
import pytest

from plumbline.llm import phrases
from plumbline.llm.phrases import collocations, frequent_phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, size int, n long, words string, k int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_counts(rows, longest):
    counts, total = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, total


def plain(rows, min_count, longest, swallowed, top):
    counts, total = plain_counts(rows, longest)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    around = collections.Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = lang, words[i : i + size]
                around[inner] = max(around[inner], a)
    kept = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * around[lang, words] >= swallowed * a:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, (left, right) = min((1000000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        kept[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, found in kept.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """Two skewed vocabularies, odd blanks and marks, nulls, empties, copies, a long text, repeated rows."""
    rng = random.Random(11)
    vocabulary = ["the", "Of", "schön", "É", "x1", "new", "york", "city", "a b", "it's"]
    out = []
    for i in range(250):
        words = rng.choices(vocabulary, [30, 20, 5, 3, 8, 6, 6, 4, 2, 2], k=rng.choice([0, 1, 2, 5, 30]))
        text = ""
        for w in words:
            text += w + rng.choice([" "] * 12 + ["  ", "\t", " \t ", ". ", ",", "\n", ";\r\n", " ? ", "\x0b"])
        out.append((i, text, rng.choice(["en", "en", "de", None, "und", ""])))
    out += [(400 + i, "New York City hall. new york", "en") for i in range(60)]
    out += [(500 + i, f"rare{i // 10} pair{i // 10} end", "de") for i in range(95)]
    out += [(None, "the new york city", "en")] * 12 + [(None, None, None), (600, None, "en"), (601, "", "xx"), (602, " .,", "xx")]
    out += [(700, "aa " * 50, "rep"), (701, "long word " * 60_000, "big"), (702, "b" * 100_000, "big"), out[0], out[0]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, "y", 3) for row in rows], SCHEMA)


@pytest.mark.parametrize("min_count,longest,swallowed,top", [(10, 3, 50, 2000), (3, 3, 50, 5), (4, 4, 80, None), (10, 2, 1, 3)])
def test_equals_plain_counting(spark, rows, min_count, longest, swallowed, top):
    found = collocations(table(spark, rows), min_count, longest, swallowed, top).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, min_count, longest, swallowed, top)


@pytest.mark.parametrize("sample", [0.0, 0.02, 0.5, 1.0])
def test_any_sample_gives_the_same(spark, rows, sample):
    """Whatever the sample misses is found by one further pass."""
    known, passes = frequent_phrases(table(spark, rows), 5, 3, sample)
    counts, total = plain_counts(rows, 3)
    wanted = {(lang, len(w), " ".join(w)): n for (lang, w), n in counts.items() if n >= 5}
    wanted |= {(lang, 0, ""): n for lang, n in total.items() if n}
    assert {(r.lang, r["size"], r.phrase): r.n for r in known.collect()} == wanted
    assert passes == 2 if sample < 0.5 else passes <= 2
    if sample == 1.0:
        assert passes == 1  # the sample is the whole


def test_a_full_filter_loses_nothing(spark, rows):
    """A filter of 64 bits holds everything; counts stay exact."""
    found = collocations(table(spark, rows), 3, 3, 50, None, 0.3, 6).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 3, 3, 50, None)


def test_small_blocks_and_early_hand_over(rows, monkeypatch):
    import pyarrow as pa

    class Passes:
        value = [{}]

    monkeypatch.setattr(phrases, "BLOCK_BYTES", 64)
    monkeypatch.setattr(phrases, "HELD", 10)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] for r in rows]})
    found = collections.Counter()
    for part in phrases._counts(Passes, 3, True, [1])(iter([batch])):
        for r in part.to_pylist():
            phrase, _, lang = r["key"].partition(phrases.MARK)
            found[lang, int(phrase != ""), phrase] += r["n"]
    counts, total = plain_counts([(i, t, g or "und") for i, t, g in rows], 1)
    wanted = {(lang, 1, w[0]): n for (lang, w), n in counts.items()} | {(lang, 0, ""): n for lang, n in total.items() if n}
    assert found == wanted


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(table(spark, [(1, None, None), (2, "", "en"), (3, "...", "en")])).count() == 0


def test_large_counts_are_exact(spark):
    """The score's products pass 64 bits."""
    row = spark.sql("SELECT cast(3e15 AS bigint) AS a, cast(4e15 AS bigint) AS l, cast(5e15 AS bigint) AS r")
    wide = row.selectExpr("cast(a AS decimal(19,0)) AS a", "cast(l AS decimal(19,0)) AS l", "cast(r AS decimal(19,0)) AS r")
    score = wide.selectExpr("(cast(1000000 AS decimal(7,0)) * (a * a)) div (l * r) AS s").first()["s"]
    assert score == 1000000 * (3 * 10**15) ** 2 // (20 * 10**30)


def test_filters_hold_what_was_put_in():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bits = np.unique(np.concatenate(phrases.places_of(hashes, 20)))
    slots, at = np.unique(bits >> np.uint64(6), return_inverse=True)
    table = np.zeros(len(slots), np.uint64)
    np.bitwise_or.at(table, at, np.uint64(1) << (bits & np.uint64(63)))
    held = phrases.PhraseFilter(20, slots, table)
    assert held.holds(hashes).all()
    assert (pickle.loads(pickle.dumps(held)).table == held.table).all()
    assert held.holds(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.01
