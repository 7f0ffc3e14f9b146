"""Language identification: the family first, then the language within it, by pairwise linear SVMs."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import ship_package, stored

FEATURES = 4096
ORDERS = (1, 2, 3, 4)
SAMPLE_PER_LANGUAGE = 800
UNDETERMINED = "und"

#: Languages of a family; a language listed nowhere is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ca gl ro oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi ur bn mr gu pa ne".split(),
    "semitic": "ar he mt am".split(),
    "celtic": "ga cy br gd".split(),
}
FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}


def family_of(language: str) -> str:
    return FAMILY_OF.get(language, language)


def features(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per text the hashed byte n-grams of its lower-cased bytes: square roots of counts, at length one."""
    n = len(places) - 1
    low = K.LOWER[data].astype(np.uint64)
    owner = np.repeat(np.arange(n), np.diff(places))
    left = np.repeat(places[1:], np.diff(places)) - np.arange(len(data))  # bytes to the text's end
    counts = np.zeros(n * FEATURES, np.float32)
    gram = np.zeros(len(data), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        size = len(data) - order + 1
        if size <= 0:
            break
        gram = (gram[:size] << np.uint64(8)) | low[order - 1 :]
        inside = left[:size] >= order
        salted = gram[inside] + np.uint64(order << 40)
        slot = ((salted * np.uint64(K.BASE)) >> np.uint64(64 - (FEATURES - 1).bit_length())).astype(np.int64)
        counts += np.bincount(owner[:size][inside] * FEATURES + slot, minlength=n * FEATURES).astype(np.float32)
    x = np.sqrt(counts.reshape(n, FEATURES))
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Linear SVM with squared hinge loss and balanced classes by accelerated gradient; the bias comes last."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32, copy=False)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        v = x.T @ (share * (x @ v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1.0 / (2 * top + penalty)
    w = np.zeros(x.shape[1], np.float32)
    before, t = w, 1.0
    for _ in range(steps):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = w + (t - 1) / t_next * (w - before)
        slack = np.maximum(0, 1 - y * (x @ at))
        before, w = w, at - rate * (penalty * at - 2 * (x.T @ (share * y * slack)))
        t = t_next
    return w.astype(np.float32)


class Model:
    """Weights of every pair of families, and of every pair of languages within a family."""

    def __init__(self, weights: dict[tuple[str, str, str], np.ndarray], languages: list[str]):
        self.families: dict[str, list[str]] = {}
        for language in sorted(languages):
            self.families.setdefault(family_of(language), []).append(language)
        self.pairs = sorted(weights)
        self.weights = (
            np.stack([weights[p] for p in self.pairs]) if self.pairs else np.zeros((0, FEATURES + 1), np.float32)
        )

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        family, sure = self._decide("", list(self.families), margins)
        out, score = [""] * len(x), sure.copy()
        for number, (name, members) in enumerate(self.families.items()):
            rows = np.flatnonzero(family == number)
            chosen, within = self._decide(name, members, margins[rows])
            score[rows] *= within
            for row, c in zip(rows, chosen):
                out[row] = members[c]
        return out, score

    def _decide(self, level: str, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One against one: the name with most duels won, the sum of its chances breaking ties."""
        votes = np.zeros((len(margins), len(names)))
        for i, j in itertools.combinations(range(len(names)), 2):
            chance = 1 / (1 + np.exp(-4 * margins[:, self.pairs.index((level, names[i], names[j]))]))
            votes[:, i] += (chance >= 0.5) + chance / 1000
            votes[:, j] += (chance < 0.5) + (1 - chance) / 1000
        if len(names) < 2:
            return np.zeros(len(margins), np.int64), np.ones(len(margins))
        best = votes.argmax(1)
        chance = np.ones(len(margins))
        for i, j in itertools.combinations(range(len(names)), 2):
            p = 1 / (1 + np.exp(-4 * margins[:, self.pairs.index((level, names[i], names[j]))]))
            chance = np.where(best == i, np.minimum(chance, p), np.where(best == j, np.minimum(chance, 1 - p), chance))
        return best, chance


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, places = K.text_bytes(batch.column("text"))
        for i, j in K.blocks(places, 1 << 20):
            for a in range(i, j, 256):
                b = min(a + 256, j)
                x = features(data[places[a] : places[b]], places[a : b + 1] - places[a])
                yield pa.RecordBatch.from_pydict(
                    {"lang": batch.column("lang").slice(a, b - a), "x": pa.array([r.tobytes() for r in x], pa.binary())}
                )


def _train(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    level, first, second = (k.as_py() for k in key)
    x = K.text_bytes(table.column("x"))[0].view(np.float32).reshape(len(table), FEATURES)
    y = np.where(np.array(table.column("side").to_pylist()), 1.0, -1.0).astype(np.float32)
    del table
    order = np.lexsort((x[:, 0], y))  # the same result for any order of arrival
    x, y = x[order], y[order]
    w = train_svm(x, y)
    del x
    K.release()
    return pa.table({"level": [level], "first": [first], "second": [second], "weights": [w.tobytes()]})


def is_held_out(id_col: Column) -> Column:
    """Documents whose CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """Learn from about ``per_language`` labelled documents a language, chosen by a hash of the id and text.

    That bound is the only one; the documents' whole texts are read, repeated rows once. Languages are
    the labels of texts with letters; ``und`` is none. Each pair of classes is trained by a task of its own.
    """
    ship_package(docs.sparkSession)
    labelled = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    ).filter(F.col("id").isNotNull() & ~is_held_out(F.col("id")) & has_letters(F.col("text")))
    labelled = labelled.filter(F.col("lang") != UNDETERMINED)
    counts = dict(labelled.groupBy("lang").agg(F.count_distinct("id", "mark")).collect())  # one row per language
    spark = docs.sparkSession
    if not counts:
        return Model({}, [])
    chance = spark.createDataFrame([(n, per_language / c) for n, c in counts.items()], "lang string, chance double")
    drawn = F.pmod(F.xxhash64("id", "mark"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (
        labelled.join(F.broadcast(chance), "lang")  # one row per language
        .filter(drawn < F.col("chance"))
        .dropDuplicates(["lang", "id", "mark"])
        .select("lang", "text")
    )
    x = stored(sample.repartition(8).mapInArrow(K.tidy(_featured), "lang string, x binary"), "language-features")
    languages = sorted(r.lang for r in x.select("lang").distinct().collect())  # as many as languages
    families = sorted({family_of(n) for n in languages})
    duels = []  # level, first, second, language, whether it is of the first
    for a, b in itertools.combinations(families, 2):
        duels += [("", a, b, n, family_of(n) == a) for n in languages if family_of(n) in (a, b)]
    for family in families:
        members = [n for n in languages if family_of(n) == family]
        for a, b in itertools.combinations(members, 2):
            duels += [(family, a, b, n, n == a) for n in (a, b)]
    if not duels:
        return Model({}, languages)
    plan = spark.createDataFrame(duels, "level string, first string, second string, lang string, side boolean")
    trained = (
        x.join(F.broadcast(plan), "lang")  # one row per pair and language
        .groupBy("level", "first", "second")
        .applyInArrow(_train, "level string, first string, second string, weights binary")
    )
    weights = {(r.level, r.first, r.second): np.frombuffer(r.weights, np.float32) for r in trained.collect()}
    return Model(weights, languages)  # every language has rows, so every duel is trained


def _predict(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            data, places = K.text_bytes(batch.column("text"))
            known = batch.column("letters").to_numpy(zero_copy_only=False) & bool(model.families)
            names, scores = [], []
            for i, j in K.blocks(places, 1 << 20):
                for a in range(i, j, 256):
                    b = min(a + 256, j)
                    if model.families:
                        found, score = model.predict(features(data[places[a] : places[b]], places[a : b + 1] - places[a]))
                    else:
                        found, score = [UNDETERMINED] * (b - a), np.zeros(b - a)
                    names += [n if k else UNDETERMINED for n, k in zip(found, known[a:b])]
                    scores += np.where(known[a:b], score, 0.0).tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("id"),
                    "mark": batch.column("mark"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(scores, pa.float64()),
                }
            )

    return run


def identify_languages(
    docs: DataFrame,
    model: Model | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    marked: bool = False,
) -> DataFrame:
    """Per document its predicted language and a score from 0 to 1 (the weakest duel won, times levels).

    A document's vector holds hashed byte 1- to 4-grams of its whole text. The
    family is decided first, then the language among its members, each by linear
    SVMs for every pair. The model learns from labelled documents that are not held
    out (see ``learn``) unless one is given; language, source and id are never
    inputs of a prediction.

    ``und`` with score 0 for null texts, texts without letters, and where nothing
    could be learned. Null ids are not held out and not learned from. Repeated
    rows each get their row; ``marked`` adds ``mark``, the xxhash64 of the text, which
    tells rows of one id apart. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    model = model or learn(docs, id_col, text_col, lang_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("mark"),
        is_held_out(F.col(id_col)).alias("held_out"),
        has_letters(F.col(text_col)).alias("letters"),
        F.col(text_col).alias("text"),
    )
    found = rows.mapInArrow(K.tidy(_predict(model)), "doc_id long, mark long, held_out boolean, lang_pred string, score double")
    return found if marked else found.drop("mark")
