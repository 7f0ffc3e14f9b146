"""Language identification and mixing: held-out accuracy, reached targets, odd inputs; the pipeline end to end."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm.language_id import Model, identify_languages, learn, train_svm
from plumbline.llm.mixing import domains_of_labels, fit_rates, mix, mixed_documents
from plumbline.llm.storage import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_accuracy(spark, documents):
    more = [(-1, None, "en"), (-2, "", "en"), (-3, "12 34 !?", None), (None, "the and of that", "en"), (-4, "é", None)]
    docs = documents.select("doc_id", "text", "lang").union(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    found = {r.doc_id: r for r in identify_languages(docs).collect()}
    assert len(found) == documents.count() + len(more)
    for i in (-1, -2, -3):
        assert found[i].lang_pred == "und" and found[i].score == 0.0
    assert found[-4].lang_pred != "und" and not found[None].held_out
    truth = dict(documents.select("doc_id", "lang").collect())
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    held = [i for i in truth if found[i].held_out]
    assert sum(found[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*truth.values(), "und"} for r in found.values())


def test_labels_of_held_out_documents_and_other_columns_do_not_matter(documents):
    spoiled = documents.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang"))
    ).withColumns({"source": F.lit("s"), "letters": F.lit(1), "held_out": F.lit(2)})
    plain = {r.doc_id: r.lang_pred for r in identify_languages(documents).collect()}
    assert {r.doc_id: r.lang_pred for r in identify_languages(spoiled).collect()} == plain


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert identify_languages(docs).first().lang_pred == "und"
    one = spark.createDataFrame([(i, "some text", "en") for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify_languages(one).collect()} == {"en"}
    assert identify_languages(docs.limit(0)).collect() == []


def test_languages_of_letterless_texts_are_left_out_alone(spark, documents):
    docs = documents.select("doc_id", "text", "lang")
    truth = dict(docs.select("doc_id", "lang").collect())
    plain = {r.doc_id: r.lang_pred for r in identify_languages(docs).collect()}
    assert len(set(plain.values())) > 1
    odd = [(10**6 + i, t, n) for i in range(40) for t, n in [(["12 34", "...", "", None][i % 4], ["und", "zxx", "", "xx"][i // 10])]]
    odd += [(10**7 + i, "letters of no known language", "und") for i in range(40)]
    found = {r.doc_id: r.lang_pred for r in identify_languages(docs.union(spark.createDataFrame(odd, docs.schema))).collect()}
    assert {i: found[i] for i in truth} == plain
    assert {found[i] for i, t, _ in odd if i < 10**7} == {"und"} and "und" not in {found[10**7 + i] for i in range(40)}


def test_a_language_of_one_repeated_text_is_learned(spark):
    rows = [(i, f"the and of that {i}", "en") for i in range(60)] + [(8, "der und die das", "de")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for model in (learn(docs), learn(docs, per_language=40)):
        assert sorted(n for members in model.families.values() for n in members) == ["de", "en"]


def test_language_stage_without_labels_rejects_letterless_texts_only(spark, documents):
    more = [(10**6, None), (10**6 + 1, "12 34"), (10**6 + 2, "é")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = documents.unionByName(spark.createDataFrame([(i, t, None, "x", 0) for i, t in more], schema))
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language(spark, bare, SF)
    assert left.columns == documents.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.filter(r"text rlike '\\p{L}'").collect()}


def test_model_decides_family_then_language():
    x = np.eye(4096, dtype=np.float32)[:3]
    w = {k: np.zeros(4097, np.float32) for k in (("", "germanic", "romance"), ("germanic", "de", "en"))}
    w["", "germanic", "romance"][:3] = (2, 2, -2)
    w["germanic", "de", "en"][:2] = (3, -3)
    names, scores = Model(w, ["en", "de", "fr"]).predict(x)
    assert names == ["de", "en", "fr"] and ((scores > 0.5) & (scores <= 1)).all()


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0, 0.5, 0]) + 0.3 > 0, 1, -1).astype(np.float32)
    w = train_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def brute_rates(tokens, chances, weights, budget, rounds=20000):
    """Plain projected gradient over all documents at once."""
    rates = np.full(len(tokens), budget / tokens.sum())
    target = np.array(weights) / sum(weights) * budget
    step = 1 / np.linalg.eigvalsh((chances * tokens[:, None]).T @ chances).max()
    for _ in range(rounds):
        error = (tokens * rates) @ chances - target
        rates = np.maximum(0, rates - step * (chances @ error))
    return (tokens * rates) @ chances


@pytest.mark.parametrize("weights", [(0.5, 0.5), (0.9, 0.1), (1.0, 0.0)])
def test_rates_reach_targets_as_well_as_brute_force(spark, weights):
    rng = np.random.default_rng(4)
    p = rng.beta(0.4, 0.4, size=400)
    tokens = rng.integers(0, 50, size=400)
    rows = [(i, int(n), [float(a), float(1 - a)]) for i, (n, a) in enumerate(zip(tokens, p))]
    chances = spark.createDataFrame(rows, "doc_id long, n_tokens long, chances array<double>")
    steps, base = fit_rates(chances, list(weights))
    rates = np.full(400, base)
    matrix = np.stack([p, 1 - p], 1)
    for s in steps:
        rates = np.maximum(0, rates - matrix @ s)
    reached = (tokens * rates) @ matrix
    target = np.array(weights) * tokens.sum()
    best = brute_rates(tokens.astype(float), matrix, weights, tokens.sum())
    assert (rates >= 0).all()
    assert np.linalg.norm(reached - target) <= np.linalg.norm(best - target) + 0.01 * tokens.sum()


def test_mixing(spark, documents):
    labelled = domains_of_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    odd = spark.createDataFrame([(None, None, "x"), (-1, "", "x"), (-1, "", "x")], "doc_id long, text string, rate string")
    docs = documents.select("doc_id", "text", F.lit("x").alias("rate")).union(odd)
    weights = {"good": 0.9, "poor": 0.07, "toxic": 0.03, "unheard": 0.5}
    found = mix(docs, labelled, weights)
    rows = found.collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    total = sum(r.n_tokens for r in rows)
    for domain in ("good", "poor", "toxic"):
        reached = sum(r.n_tokens * r.rate * r.chances[domain] for r in rows)
        assert reached == pytest.approx(weights[domain] * total, rel=0.02)
    assert {r.n_tokens for r in rows if r.doc_id in (None, -1)} == {0}
    copies = {(r.doc_id, r.mark): r.copies for r in rows}
    out = mixed_documents(docs, found)
    assert out.columns == docs.columns
    assert out.count() == sum(copies[r.doc_id, r.mark] for r in rows)


def test_mixing_without_labels_or_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = mix(documents, none, {"good": 1.0}).collect()
    assert {round(r.rate, 9) for r in rows} == {1.0}
    assert mix(documents.limit(0), none, {"good": 1.0}).collect() == []
    one = spark.createDataFrame([(0, "good")], "doc_id long, domain string")
    assert {round(r.rate, 9) for r in mix(documents, one, {"good": 1.0}).collect()} == {1.0}


def test_a_rare_domain_is_learned_however_many_labels_there_are(spark):
    """Of 40,000 labels four name a domain; chances stay those among all labels."""
    n, rare = 40000, [17, 12020, 16021, 28024]  # their ids hash high, so a draw of 6,000 from all misses them
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id").isin(rare), F.lit("vile foul words")).otherwise(F.lit("some plain prose stands here")).alias("text"),
    )
    domain = F.when(F.col("doc_id").isin(rare), "toxic").when(F.col("doc_id") % 10 == 0, "poor").otherwise("good")
    found = mix(docs, docs.select("doc_id", domain.alias("domain")), {"good": 0.8, "poor": 0.1, "toxic": 0.1})
    rows = {r.doc_id: r.chances for r in found.filter(F.col("doc_id").isin([*rare, 1])).collect()}
    assert sorted(rows[1]) == ["good", "poor", "toxic"]
    assert all(max(rows[i], key=rows[i].get) == "toxic" for i in rare)
    assert sum(rows[1].values()) == pytest.approx(1) and rows[1]["toxic"] < 0.01
    assert rows[1]["good"] == pytest.approx(0.9, abs=0.02)


def test_mixing_counts_only_labels_of_given_documents(spark, documents):
    labelled = domains_of_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    weights = {"good": 0.9, "poor": 0.07, "toxic": 0.03}
    assert mix(documents.limit(0), labelled, weights).collect() == []
    gone = documents.join(labelled.filter("domain = 'toxic'"), "doc_id", "left_anti")
    rows = mix(gone, labelled, weights).collect()
    assert len(rows) == gone.count() and {tuple(sorted(r.chances)) for r in rows} == {("good", "poor")}
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.rate * r.chances["good"] for r in rows) == pytest.approx(0.9 / 0.97 * total, rel=0.02)
    only = gone.join(labelled.filter("domain = 'poor'"), "doc_id", "left_anti")
    assert {tuple(r.chances.items()) for r in mix(only, labelled, weights).collect()} == {(("good", 1.0),)}


def test_stages_return_documents_and_take_effect(spark, documents):
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "123 456"), (10**6 + 3, None)]
    text = documents.filter("length(text) > 900").orderBy("doc_id").first()
    words = text.text.split(" ")
    words[5] = "changed"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 150").first().text
    extra = odd + [(10**6 + 4, " ".join(words)), (10**6 + 5, f"Before it. {item} And after."), (text.doc_id, text.text)]
    more = spark.createDataFrame(
        [(i, t, "en", "planted", 0) for i, t in extra], "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs = documents.unionByName(more)
    sizes, ids = [], []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        if name != "tokens":
            assert out.columns == documents.columns
        sizes.append(out.count())
        ids.append({r.doc_id for r in out.select("doc_id").collect()})
        docs = out
    language, near, benchmark, mixture, tokens = ids
    assert not language & {i for i, _ in odd} and {10**6 + 4, 10**6 + 5, text.doc_id} <= language
    assert (10**6 + 4) not in near and text.doc_id in near and (10**6 + 5) in near
    assert (10**6 + 5) not in benchmark and sizes[1] == len(near)
    assert tokens == mixture <= benchmark and sizes[4] == sizes[3]


def test_stages_remove_rows_and_not_ids(spark, documents):
    """A rejected text takes no other text of its id along, be the id null or repeated."""
    clean = [r.text for r in documents.filter("length(text) > 400").orderBy("doc_id").limit(8).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 150").first().text
    leak = f"Before it. {item} And after."

    def left(stage, rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        docs = spark.createDataFrame([(i, t, "en", "planted", 0) for i, t in rows], schema)
        out = stage(spark, documents.select(docs.columns).unionByName(docs), SF).filter("source = 'planted'")
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    a, b = 10**6, 10**6 + 1
    good = [(None, clean[0]), (None, "plain words"), (a, clean[1]), (b, "the same words"), (b, "the same words")]
    bad = [(None, None), (None, "12 34"), (a, None), (a, "..."), (b, "")]
    assert left(corpus_pipeline.language, good + bad) == sorted(good, key=repr)
    leaks = [(None, leak), (a, leak)]
    assert left(corpus_pipeline.benchmark_passages, good + leaks) == sorted(good, key=repr)
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words[:-1])
    kept = [(None, near), (a, " ".join(words)), (b, "alone it stays"), (b + 1, "something else stands here")]
    assert left(corpus_pipeline.near_copies, [*kept, (b, near)]) == sorted(kept, key=repr)


def test_entry_lists_the_operators():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_unsure_languages_go_and_held_out_documents_stay(spark):
    """The score rule of the language stage rejects junk of a few letters, and next to no held-out document."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = identify_languages(docs).collect()
    held = [r for r in found if r.held_out]
    assert held and sum(r.score < corpus_pipeline.SURE for r in held) <= 0.01 * len(held)
    kept = corpus_pipeline.language(spark, docs, SF).select("doc_id").collect()
    unsure = {r.doc_id for r in found if r.lang_pred == "und" or r.score < corpus_pipeline.SURE}
    assert {r.doc_id for r in kept} == {r.doc_id for r in found} - unsure
