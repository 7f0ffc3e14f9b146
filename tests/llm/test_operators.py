"""Every operator against brute force, over nulls, ties, empty and long texts, and empty tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import random
import re
import time
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import kernels as K
from plumbline.llm.decontaminate import decontaminate
from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.near_dedup import connected_components, near_duplicates
from plumbline.llm.sharding import WHOLE_PART, shard
from plumbline.llm.substring_dedup import substring_dedup
from plumbline.llm.suffix_dedup import repeated_starts, suffix_dedup
from plumbline.llm.token_files import Encoder, encode_documents, tokenizer_path
from plumbline.llm.warc import archive_pages, original_records, write_archive
from plumbline.session import work_path

SCHEMA = "doc_id long, text string, keep_id string, salt int, bucket int, node long, mark long, text_sha256 string"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sentences(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(["the", "Of", "schön", "a", "re", "x1", "tion.", "and\n"]) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    """Ids and texts: passages shared, copies, near copies, nulls, empties, a long text, repeated rows."""
    rng = random.Random(7)
    shared = [sentences(rng, 40) for _ in range(4)]
    out = []
    for i in range(90):
        parts = [sentences(rng, rng.randint(0, 30))]
        if i % 3 == 0:
            piece = rng.choice(shared).split(" ")
            a = rng.randint(0, 20)
            parts.append(" ".join(piece[a : a + rng.randint(5, 20)]))
        parts.append(sentences(rng, rng.randint(0, 12)))
        out.append((i, " ".join(parts)))
    base = [f"w{rng.randint(0, 999)}" for _ in range(80)]
    for i in range(100, 120):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 999)}"
        out.append((i, " ".join(words)))
    out += [(200, None), (201, ""), (202, " \t\n"), (203, None), (204, "Word"), (205, "wORD"), (206, "…!?"), (207, "")]
    out += [(i, "the same text again and again") for i in range(300, 340)]
    out += [(400, sentences(rng, 3000)), (401, "ab" * 400)]
    out += [out[0], out[0], (300, "the same text again and again")]
    rng.shuffle(out)
    return out


def frame(spark, rows, parts=3):
    filled = [(i, t, "k", 1, 2, 3, 4, "s") for i, t in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(parts)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(spark, rows):
    for keep in ("max", "min"):
        found = exact_dedup(frame(spark, rows), keep=keep)
        assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        groups = collections.defaultdict(list)
        for i, t in rows:
            groups[t or ""].append(i)
        expected = []
        for text, ids in groups.items():
            best = max(ids) if keep == "max" else min(ids)
            kept = False
            for i in ids:
                expected.append((i, best, len(ids), i == best and not kept, hashlib.sha256(text.encode()).hexdigest()))
                kept = kept or i == best
        assert result(found) == sorted(expected, key=repr)


def test_exact_dedup_of_a_hot_text_and_null_ids(spark):
    hot = [(i, "hot") for i in range(400)] + [(None, "hot"), (None, "cold"), (None, "cold"), (1000, "rare")]
    found = exact_dedup(frame(spark, hot), keep="max")
    by_text = collections.defaultdict(list)
    for r in found.collect():
        by_text[r.text_sha256].append(r)
    of = {t: by_text[hashlib.sha256(t.encode()).hexdigest()] for t in ("hot", "cold", "rare")}
    assert {(r.keep_id, r.group_size) for r in of["hot"]} == {(399, 401)}
    assert [r.doc_id for r in of["hot"] if r.kept] == [399]
    assert [r.keep_id for r in of["cold"]] == [None, None] and sum(r.kept for r in of["cold"]) == 1
    assert of["rare"][0].kept


def test_exact_dedup_can_normalise(spark):
    found = exact_dedup(frame(spark, [(1, "A b"), (2, "a B")]), normalise=lambda t: F.lower(t))
    assert {r.keep_id for r in found.collect()} == {1}


def sharded(rows, shards):
    """The same law, computed in one pass over the sorted list."""
    keyed = sorted(
        (hashlib.sha256((t or "").encode()).hexdigest(), i is not None, i or 0, len((t or "").encode()) + 1, t or "")
        for i, t in rows
    )
    total = sum(r[3] for r in keyed)
    bytes_of, begin, before, out = collections.Counter(), {}, 0, []
    for digest, *_, size, _ in keyed:
        begin.setdefault(digest, before)
        bytes_of[digest] += size
        before += size
    before, slots = 0, collections.Counter()
    for digest, known, i, size, text in keyed:
        if bytes_of[digest] * WHOLE_PART * shards <= total:
            twice = 2 * begin[digest] + bytes_of[digest]
        else:
            twice = 2 * before + size
        at = twice * shards // (2 * total)
        out.append((i if known else None, size, zlib.crc32(text.encode()), "bytes", at, slots[at], None))
        slots[at] += 1
        before += size
    return out


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_shard(spark, rows, shards):
    found = shard(frame(spark, [*rows, (None, "x"), (None, None)]), shards)
    assert result(found) == sorted(sharded([*rows, (None, "x"), (None, None)], shards), key=repr)


def test_shards_of_a_hot_text_are_cut_inside(spark):
    rows = [(i, "hot text") for i in range(3000)] + [(5000 + i, f"other {i}" * (i % 7)) for i in range(2000)]
    found = shard(frame(spark, rows, 5), 8)
    assert result(found) == sorted(sharded(rows, 8), key=repr)
    sizes = collections.Counter()
    for r in found.collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def cut_windows(rows, window):
    first = {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = SPACED.findall(t or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [1, 6, 10])
def test_substring_dedup(spark, rows, window):
    found = substring_dedup(frame(spark, rows), window)
    assert result(found) == cut_windows(rows, window)


def test_substring_dedup_leaves_null_ids_alone(spark):
    text = "a b c d e f g"
    found = substring_dedup(frame(spark, [(None, text), (None, text), (5, text), (6, text)]), 4)
    assert sorted((r.doc_id or 0, r.n_removed) for r in found.collect()) == [(0, 0), (0, 0), (5, 0), (6, 7)]


def hit_words(rows, items, window):
    def words(t):
        return LETTERED.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))

    out = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for name, text in items:
            x = words(text)
            k = min(window, len(x))
            wanted = {tuple(x[a : a + k]) for a in range(len(x) - k + 1)} if k else set()
            for a in range(len(w) - k + 1) if k else ():
                if tuple(w[a : a + k]) in wanted:
                    hit.update(range(a, a + k))
                    names.add(str(name) if name is not None else "")
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out, key=repr)


def test_decontaminate(spark, rows, monkeypatch):
    by_id = dict(rows)
    items = [
        (1, " ".join((by_id[0] or "").split(" ")[:14])), (2, "of THE"), (3, None), (4, ""), (5, "schön"),
        (None, by_id[400][200:300]), (6, by_id[400][100:900]), (6, "re re"), (7, "never seen words here at all"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for window in (3, 10):
        expected = hit_words(rows, items, window)
        for limit in (16 << 20, 600):  # one block, then several
            monkeypatch.setattr("plumbline.llm.decontaminate.ITEM_BLOCK_BYTES", limit)
            found = decontaminate(frame(spark, rows), benchmark, window=window, gram=min(5, window))
            assert result(found.select("doc_id", "n_words", "n_hit", "items")) == expected


def test_decontaminate_takes_one_python_worker_a_task(spark, rows):
    benchmark = spark.createDataFrame([(1, "of the")], "item_id long, text string")
    plan = decontaminate(frame(spark, rows), benchmark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def jaccard_components(rows, k, percent):
    sets = []
    for i, t in rows:
        w = SPACED.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        grams = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        sets.append((i, grams))
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((top(i), top(j)))
            root[y] = x
    return sorted(((i, len(s), top(i), top(i) == i) for i, s in sets), key=repr)


@pytest.mark.parametrize("k", [1, 4, 5])
def test_near_duplicates(spark, rows, k):
    assert result(near_duplicates(frame(spark, rows), k, 80)) == jaccard_components(rows, k, 80)


def test_near_duplicates_of_a_large_group(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(60)] = f"y{rng.randint(0, 9999)}"
        rows.append((i, " ".join(words)))
    assert result(near_duplicates(frame(spark, rows), 4, 80)) == jaccard_components(rows, 4, 80)


def test_near_duplicates_without_ids_stay_apart(spark):
    found = near_duplicates(frame(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")]), 2)
    assert result(found) == sorted([(None, 5, None, True)] * 2 + [(3, 5, 3, True)], key=repr)


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 101), (200, 300)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {found[i] for i in range(41)} == {0} and found[105] == found[101] == 100 and found[300] == 200


def cut_bytes(rows, window):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[a : a + window] for a in range(len(b) - window + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for a in range(len(b) - window + 1):
            if seen[b[a : a + window]] > 1:
                gone[a : a + window] = [True] * window
        spans = sum(1 for a in range(len(b)) if gone[a] and (a == 0 or not gone[a - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "crowded"), [(20, 1500), (20, 2), (64, 1500), (7, 1500)])
def test_suffix_dedup(spark, rows, window, crowded):
    some = [(i if i % 10 else None, t) for i, t in rows]
    assert result(suffix_dedup(frame(spark, some), window, crowded)) == cut_bytes(some, window)


def test_merged_transforms_find_repeated_windows(monkeypatch):
    rng = random.Random(11)
    for _ in range(60):
        window = rng.choice([4, 6, 12])
        symbol = rng.choice([s for s in range(1, window + 1) if window % s == 0])
        segments = [
            bytes(rng.choice(b"ab") for _ in range(rng.randint(window, window + 25))) for _ in range(rng.randint(1, 10))
        ]
        monkeypatch.setattr("plumbline.llm.suffix_dedup.SHARD_BYTES", rng.choice([10, 60, 1000]))
        seen = collections.Counter(s[a : a + window] for s in segments for a in range(len(s) - window + 1))
        expected = [[a for a in range(len(s) - window + 1) if seen[s[a : a + window]] > 1] for s in segments]
        assert [x.tolist() for x in repeated_starts(segments, window, symbol)] == expected


def test_merging_holds_a_bounded_multiple_of_the_segments():
    rng = random.Random(3)
    segments = [rng.randbytes(464) for _ in range(1500)]
    repeated_starts(segments[:10], 400, 50)  # what is computed once
    tracemalloc.start()
    try:
        assert not any(len(x) for x in repeated_starts(segments, 400, 50))
        assert tracemalloc.get_traced_memory()[1] < 90 * 464 * 1500
    finally:
        tracemalloc.stop()


def test_encoder_forgets_pieces_that_came_once(monkeypatch):
    encoder, learned = Encoder(tokenizer_path(), limit=100), collections.Counter()
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: (learned.update(pieces), learn(pieces)))
    for i in range(0, 4000, 40):
        encoder.encode(["often seen words " + " ".join(f"w{i + j}x" for j in range(40))])
        assert len(encoder.index) <= 200
    assert learned[" seen"] == 1


def test_encoder_equals_the_tokenizer_on_whole_texts():
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path(), limit=500)
    rng = random.Random(1)
    pieces = ["a", "B", " ", " ", "  ", "\n", "\t", " \n", "1", "é", "'s", "'ll", ".", "!?", "<|endoftext|>", "中", "\x1c", "\x85", "　", ""]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for i in range(0, len(texts), 200):
        flat, sizes = encoder.encode(texts[i : i + 200])
        expected = [plain.encode(t, add_special_tokens=False).ids for t in texts[i : i + 200]]
        assert flat.tolist() == [x for ids in expected for x in ids]
        assert sizes.tolist() == [len(ids) for ids in expected]


def test_encoder_cuts_at_stops_and_wide_characters():
    """Also where a text ends or begins at a cut, in arrays with nulls that don't begin at their first value."""
    from tokenizers import Tokenizer

    import pyarrow as pa

    plain, encoder = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path(), limit=2000)
    rng = random.Random(2)
    pieces = ["ab", "Z", "é", "Ñ", "×", "÷", "ß", " ", " ", "\n", "\r", ".", ",", ":", "'", "'s", "7", "#", "\u00a0", "\u2003", "\u1680", "\u3000", "\u2014", "か", "ქ", "я", "𝒳", "\ue000", "\0", "<|endoftext|>"]
    texts = [rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(20000)]
    whole = pa.array(texts, pa.string())
    for i in range(0, len(texts), 500):
        flat, sizes = encoder.encode(whole.slice(i, 500))
        expected = [plain.encode(t or "", add_special_tokens=False).ids for t in texts[i : i + 500]]
        assert flat.tolist() == [x for ids in expected for x in ids]
        assert sizes.tolist() == [len(ids) for ids in expected]
    for nothing in ([], ["", ""], pa.array([None], pa.string())):
        flat, sizes = encoder.encode(nothing)
        assert flat.tolist() == [] and sizes.tolist() == [0] * len(nothing)


def test_encoder_remembers_words_without_what_stands_beside_them():
    words = ["".join(w) for w in itertools.product("abc", repeat=3)]
    encoder = Encoder(tokenizer_path())
    encoder.encode([f"{a} {b}.\n{c}, {a}" for a, b, c in itertools.product(words, repeat=3)])
    assert len(encoder.index) <= 3 * len(words) + 3  # with a space before, without, and the stops


def test_token_files(spark, rows):
    from tokenizers import Tokenizer

    import numpy as np

    plain, start, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    some = [*rows, (None, "no id"), (None, None)]
    for i, t in sorted(some, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert result(encode_documents(frame(spark, some))) == sorted(expected, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, size int")


def test_archive(spark):
    rows = [
        (1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://ü b\nc", None), (4, "u", ""), (5, "v", "é" * 50000),
        (6, "w", "WARC/1.1\r\nContent-Length: 9\r\n\r\n"), (7, "z", "é" * 50000), (2, None, "<p>x</p>"), (None, "n", "<p>x</p>"), (8, "q", "\r\n"),
    ]
    import base64

    def record(i, text, best):
        raw = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        return (i, len(raw), digest, "response" if best is None else "revisit", best)

    best = {"<p>x</p>": 2, "": 4, "é" * 50000: 7}
    expected = []
    first = True
    for i, _, text in rows:
        of = best.get(text or "", i)
        response = i == of and not (i == 2 and not first)
        first = first and i != 2
        expected.append(record(i, text, None if response else of))
    assert result(archive_pages(pages(spark, rows))) == sorted(expected, key=repr)
    small = archive_pages(pages(spark, rows), min_bytes=9)
    assert {r.page_id for r in small.collect() if r.record_type == "revisit"} == {5}
    assert small.count() == len(rows)
    folder = work_path(spark, "warc-test")
    write_archive(pages(spark, rows), folder)
    whole = original_records(spark, folder).collect()
    assert sorted(((r.page_id or 0), bytes(r.payload)) for r in whole) == sorted(((i or 0), (t or "").encode()) for i, _, t in rows)
    assert all(bytes(r.header).startswith(b"WARC/1.1\r\nWARC-Type: re") for r in whole)


OPERATORS = {
    "exact": lambda spark, df: exact_dedup(df),
    "shard": lambda spark, df: shard(df),
    "substring": lambda spark, df: substring_dedup(df),
    "decontaminate": lambda spark, df: decontaminate(df, spark.createDataFrame([], "item_id long, text string")),
    "near": lambda spark, df: near_duplicates(df),
    "suffix": lambda spark, df: suffix_dedup(df),
    "tokens": lambda spark, df: encode_documents(df),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark, frame(spark, [], 1)).collect() == []
    only = OPERATORS[name](spark, frame(spark, [(None, None), (1, None), (1, None), (2, "")], 2))
    assert only.count() == 4


def test_empty_archive(spark):
    assert archive_pages(pages(spark, [])).collect() == []


def test_sliding_least():
    import numpy as np

    rng = np.random.default_rng(0)
    for n, width in itertools.product((0, 1, 5, 40), (1, 2, 3, 7, 8, 39, 60)):
        x = rng.integers(0, 50, n)
        assert K.sliding_least(x, width).tolist() == [min(x[i : i + width]) for i in range(n - width + 1)]


def test_tokenizers_that_cannot_be_used_are_refused(tmp_path):
    """Ids beyond the width, pieces that are not cut at spaces, texts that are changed first."""
    from plumbline.llm.token_files import check_tokenizer

    def described(**more):
        base = {"model": {"vocab": {"a": 0, "b": 65536}}, "pre_tokenizer": {"type": "ByteLevel"}, "normalizer": None}
        (tmp_path / "t.json").write_text(json.dumps(base | more))
        return str(tmp_path / "t.json")

    check_tokenizer(tokenizer_path(), 2)
    check_tokenizer(described(), 4)
    check_tokenizer(described(pre_tokenizer={"type": "Sequence", "pretokenizers": [{"type": "ByteLevel"}]}), 4)
    for path, width in ((described, 2),):
        with pytest.raises(ValueError):
            check_tokenizer(path(), width)
    for wrong in ({"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}, {"normalizer": {"type": "NFC"}}, {"added_tokens": [{"id": 1 << 32}]}):
        with pytest.raises(ValueError):
            check_tokenizer(described(**wrong), 4)


def test_a_worker_forgets_its_encoder_when_idle(monkeypatch):
    from plumbline.llm import token_files

    monkeypatch.setattr(token_files, "IDLE_SECONDS", 0.2)
    kept = token_files._Kept()
    with kept.encoder(tokenizer_path()) as first:
        time.sleep(0.4)
        assert kept.encoders
    with kept.encoder(tokenizer_path()) as second:
        assert second is first
    time.sleep(0.6)
    assert not kept.encoders
