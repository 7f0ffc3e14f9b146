"""Mixing documents to target shares of domains, with soft membership."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Steps
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import small_side, stored

ROWS_PER_DOMAIN = 6000
HASHED_WORDS = 2048
PASSES = 30
TOLERANCE = 1e-9
SIGNS = r"[#$%&*|<>{}\[\]@^~=+\\]"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _described(docs: DataFrame, text_col: str) -> DataFrame:
    """Words and a few shares that tell prose from junk, all from the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.col("words")
    count = F.greatest(F.size(words), F.lit(1))
    length = F.greatest(F.length(text), F.lit(1))
    return docs.withColumn("words", _words(F.lower(text))).withColumns(
        {
            "n_tokens": F.size(words).cast("long"),
            "distinct": F.size(F.array_distinct(words)) / count,
            "mean_length": F.least(length / count, F.lit(50.0)) / 50,
            "signs": F.regexp_count(text, F.lit(SIGNS)) / length,
            "log_words": F.log(count.cast("double")) / 10,
        }
    )


class DomainModel:
    """A fitted classifier, and per class its share of all labels over its share of the rows it was fitted to."""

    def __init__(self, fitted: PipelineModel, shares: list[float]):
        self.fitted, self.shares = fitted, shares

    def chances(self, described: DataFrame) -> DataFrame:
        """Adds the chance of every class as it is among all labels, not among the drawn ones."""
        found = self.fitted.transform(described).withColumn("chances", vector_to_array("probability"))
        if len(set(self.shares)) == 1:
            return found
        shares = F.array(*[F.lit(float(s)) for s in self.shares])
        found = found.withColumn("chances", F.zip_with("chances", shares, lambda p, s: p * s))
        total = F.aggregate("chances", F.lit(0.0), lambda t, p: t + p)
        return found.withColumn("total", total).withColumn("chances", F.transform("chances", lambda p: p / F.col("total")))


def learn_domains(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_domain: int = ROWS_PER_DOMAIN
):
    """A classifier of domains from about ``per_domain`` labelled documents a domain, all of a rarer one.

    ``labelled`` has (id, domain). Only labels of given documents count. They are counted over the whole
    table, once for each id and text, and drawn by a hash of both. Returns the domains in order and a model that adds posteriors to
    documents; with fewer than two domains there is none, and the only one has chance 1.
    """
    named = labelled.select(F.col(id_col).alias("label_id"), "domain").filter("label_id IS NOT NULL AND domain IS NOT NULL")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    keys = rows.select("id", "mark").filter("id IS NOT NULL").distinct()
    given = keys.join(named.distinct(), F.col("id") == F.col("label_id")).select(
        "label_id", F.col("mark").alias("label_mark"), "domain"
    )
    given = stored(given, "domain-given")
    counts = dict(given.groupBy("domain").count().collect())  # one row per domain
    domains = sorted(counts)
    if len(domains) < 2:
        return domains, None
    chance = F.create_map(*[F.lit(x) for d in domains for x in (d, per_domain / counts[d])])
    drawn = F.pmod(F.xxhash64("label_id", "label_mark"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = stored(given.filter(drawn < F.element_at(chance, F.col("domain"))), "domain-labels")
    taken = dict(sample.groupBy("domain").count().collect())
    numbered = F.create_map(*[F.lit(x) for i, d in enumerate(domains) for x in (d, float(i))])
    # The sample is bounded, so its texts are too: repeated rows go before anything is made of them.
    texts = rows.join(F.broadcast(sample), (F.col("id") == F.col("label_id")) & (F.col("mark") == F.col("label_mark")))
    texts = texts.dropDuplicates(["label_id", "label_mark", "domain"]).select("label_id", "domain", "text")
    training = stored(
        _described(texts, "text").withColumn("class", F.element_at(numbered, F.col("domain"))).drop("text"), "domain-training"
    )
    steps = Steps(
        stages=[
            HashingTF(numFeatures=HASHED_WORDS, inputCol="words", outputCol="counts"),
            Normalizer(p=2.0, inputCol="counts", outputCol="hashed"),
            VectorAssembler(inputCols=["hashed", "distinct", "mean_length", "signs", "log_words"], outputCol="features"),
            LogisticRegression(labelCol="class", featuresCol="features", maxIter=40, regParam=1e-3, family="multinomial"),
        ]
    )
    return domains, DomainModel(steps.fit(training), [counts[d] / taken[d] for d in domains])


def posteriors(docs: DataFrame, domains: list[str], model: DomainModel | None, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, n_tokens, chances): the chance of every domain, in order."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    described = _described(rows, "text")
    if model is None:
        chances = F.array(*[F.lit(1.0) for _ in domains[:1]]) if domains else F.array(F.lit(1.0))
        return described.select("doc_id", "mark", "n_tokens", chances.alias("chances"))
    return model.chances(described).select("doc_id", "mark", "n_tokens", "chances")


def _nested(steps: list[np.ndarray], base: float) -> Column:
    """The rate after all gradient steps, each projected to be nonnegative."""
    rate = F.lit(float(base))
    for step in steps:
        move = F.lit(0.0)
        for k, s in enumerate(step):
            move = move + F.col("chances")[k] * F.lit(float(s))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def fit_rates(chances: DataFrame, weights: list[float], budget: int | None = None) -> tuple[list[np.ndarray], float]:
    """Projected-gradient steps that bring expected domain token totals to their targets.

    Minimises the squared distance between sum(tokens * rate * chance) and
    weight * budget over nonnegative rates, from the rate that spends the budget evenly. Every pass is
    one aggregate over all documents: totals, and the Gram matrix of documents with a positive rate, which scales
    the gradient. The driver holds K totals and K x K sums for K domains, whatever the number of documents.
    """
    k = len(weights)
    tokens = chances.agg(F.sum("n_tokens")).first()[0] or 0
    budget = tokens if budget is None else budget
    base = budget / tokens if tokens else 0.0
    target = np.array(weights, float) / max(sum(weights), 1e-12) * budget
    steps: list[np.ndarray] = []
    if not tokens:
        return steps, base
    best = None
    for _ in range(PASSES):
        rated = chances.withColumn("rate", _nested(steps, base)).withColumn("live", F.when(F.col("rate") > 0, F.col("n_tokens")).otherwise(0))
        p = [F.col("chances")[i] for i in range(k)]
        sums = rated.agg(
            *[F.sum(F.col("n_tokens") * F.col("rate") * p[i]) for i in range(k)],
            *[F.sum(F.col("live") * p[i] * p[j]) for i in range(k) for j in range(k)],
        ).first()
        error = np.array(sums[:k]) - target
        size = float(np.abs(error).max()) / max(budget, 1)
        if best is None or size < best[0]:
            best = (size, len(steps))
        if size <= TOLERANCE:
            break
        gram = np.array(sums[k:], float).reshape(k, k)
        scale = float(np.trace(gram)) / k
        if scale <= 0:
            break
        steps.append(np.linalg.solve(gram + 1e-9 * scale * np.eye(k), error))
    return steps[: best[1]], base


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    budget: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document its tokens, its chance of every domain, and the rate at which to use it.

    A classifier learned from the labelled table (id, domain) gives each document
    soft membership; rates are nonnegative, start at an even use of the budget (all
    tokens, if none is given) and are fitted so that expected tokens of each domain
    reach its weight of the budget. ``copies`` realises a rate as a whole number: its
    floor, and one more with the chance of the rest, by a hash of the id.

    Tokens are runs of anything but white space. Null and empty texts have none and
    keep the rate their chances give. Domains without a weight get 0; a weight for a domain
    that no label of a given document names is left out, and the others are scaled up. Repeated rows are documents of their own. Empty
    tables give no rows. Other columns are not read.
    """
    domains, model = learn_domains(docs, labelled, id_col, text_col)
    chances = stored(posteriors(docs, domains, model, id_col, text_col), "domain-chances")
    steps, base = fit_rates(chances, [weights.get(d, 0.0) for d in domains] or [1.0], budget)
    drawn = F.pmod(F.xxhash64("doc_id", "mark", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = chances.withColumn("rate", _nested(steps, base))
    names = F.array(*[F.lit(d) for d in domains]) if domains else F.array(F.lit(""))
    return rated.select(
        "doc_id",
        "mark",
        "n_tokens",
        F.map_from_arrays(names, "chances").alias("chances"),
        "rate",
        F.floor(F.col("rate") + drawn).cast("int").alias("copies"),
    )


def mixed_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, each as often as its copies say."""
    times = mixed.select(
        F.col("doc_id").alias("mix_id"), F.col("mark").alias("mix_mark"), "copies"
    ).dropDuplicates(["mix_id", "mix_mark"])
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    keyed = docs.select(held, F.col(id_col).alias("of_id"), F.xxhash64(text_col).alias("of_mark"))
    return (
        keyed.join(small_side(times), F.col("of_id").eqNullSafe(F.col("mix_id")) & (F.col("of_mark") == F.col("mix_mark")))
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select("document.*")
    )


def domains_of_labels(labels: DataFrame) -> DataFrame:
    """Domains from quality and toxicity labels: toxic, good or poor."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))
