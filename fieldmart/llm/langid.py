"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import batch, lists
from fieldmart.llm.toxicity import held_out

UNKNOWN = "und"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class Settings:
    rows_per_language: int = 500  # expected size of the sample that the weights are fitted on
    sample_bytes: int = 64 << 20
    feature_bits: int = 15
    longest: int = 3  # n-grams of 1 to so many characters
    epochs: int = 4
    # Step size and its offset, and the two penalties.
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5


@dataclass(frozen=True)
class Model:
    settings: Settings
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # features by languages, mostly zero
    temperature: float


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts_of(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the whole text in lower case, and how often each occurs."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    total = np.zeros(1 << settings.feature_bits, dtype=np.int64)
    run = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, settings.longest + 1):
        if len(points) < n:
            break
        run = run[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        mixed = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        total += np.bincount((mixed >> np.uint64(64 - settings.feature_bits)).view(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    return at, total[at]


def vector(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    at, count = counts_of(text, settings)
    value = (1 + np.log(count)) * idf[at]
    return at, value / max(np.sqrt((value**2).sum()), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(vectors: list, labels: np.ndarray, features: int, classes: int, settings: Settings) -> np.ndarray:
    """FTRL-proximal: every coordinate has its own step size, and is zero until its gradients exceed l1."""
    z, n = np.zeros((features, classes)), np.zeros((features, classes))

    def weights(at) -> np.ndarray:
        step = (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(np.abs(z[at]) > settings.l1, -(z[at] - np.sign(z[at]) * settings.l1) / step, 0.0)

    order = list(range(len(vectors)))
    chance = random.Random(11)
    for _ in range(settings.epochs):
        chance.shuffle(order)
        for i in order:
            at, value = vectors[i]
            w = weights(at)
            error = softmax(value @ w)
            error[labels[i]] -= 1
            slope = value[:, None] * error
            more = n[at] + slope**2
            z[at] += slope - (np.sqrt(more) - np.sqrt(n[at])) / settings.alpha * w
            n[at] = more
    return weights(slice(None))


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-300)).mean()
    return float(min(np.geomspace(0.02, 20, 200), key=loss))


def fit(rows: list[tuple[str, str]], idf: np.ndarray, settings: Settings) -> Model:
    """Weights from four fifths of the sample, the temperature from the rest."""
    rows = sorted(rows)
    random.Random(5).shuffle(rows)
    languages = tuple(sorted({lang for _, lang in rows}))
    if not rows:
        return Model(settings, (), idf, np.zeros((len(idf), 0)), 1.0)
    vectors = [vector(text, idf, settings) for text, _ in rows]
    labels = np.array([languages.index(lang) for _, lang in rows])
    rest = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~rest)
    weights = follow_the_leader([vectors[i] for i in learn], labels[learn], len(idf), len(languages), settings)
    logits = np.array([vectors[i][1] @ weights[vectors[i][0]] for i in np.flatnonzero(rest)])
    return Model(settings, languages, idf, weights, calibrate(logits.reshape(-1, len(languages)), labels[rest]))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    if not text or not has_letter(text) or not model.languages:
        return UNKNOWN, 0.0
    at, value = vector(text, model.idf, model.settings)
    p = softmax(value @ model.weights[at] / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def _document_counts(settings: Settings):
    """How many texts of a partition have each feature; one small table per partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << settings.feature_bits, dtype=np.int64)
        for rows in batches:
            for (text,) in lists(rows, "text"):
                total[counts_of(text, settings)[0]] += 1
        at = np.flatnonzero(total)
        yield batch("feature long, docs long", [at, total[at]])

    return count


def train(docs: DataFrame, settings: Settings | None = None) -> Model:
    """Learn from the documents that are not held out and have a language.

    Document frequencies are counted over all of them. The weights are fitted on a sample by hash of
    about `rows_per_language` rows of each language, within `sample_bytes` of text.
    """
    settings = settings or Settings()
    own = docs.where(~held_out(docs["doc_id"].cast(LongType())) & docs["lang"].isNotNull() & docs["text"].isNotNull())
    own = own.select("text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("draw"))
    sizes = {r["lang"]: (r["rows"], r["size"]) for r in own.groupBy("lang").agg(
        F.count("*").alias("rows"), F.avg(F.octet_length("text")).alias("size")
    ).collect()}
    frequencies = own.select("text").mapInArrow(_document_counts(settings), "feature long, docs long")
    frequencies = frequencies.groupBy("feature").agg(F.sum("docs").alias("docs")).collect()
    found = np.zeros(1 << settings.feature_bits)
    for row in frequencies:
        found[row["feature"]] = row["docs"]
    total = sum(rows for rows, _ in sizes.values())
    idf = np.log((1 + total) / (1 + found)) + 1
    sample, rows = None, []
    for lang, (count, size) in sorted(sizes.items()):
        most = min(settings.rows_per_language, int(settings.sample_bytes / len(sizes) / max(size, 1)) + 1)
        mine = (F.col("lang") == lang) & (F.col("draw") < int(min(1.0, most / count) * (1 << 30)))
        sample = mine if sample is None else sample | mine
    if sample is not None:
        rows = [(r["text"], r["lang"]) for r in own.where(sample).select("text", "lang").collect()]
    return fit(rows, idf, settings)


def _identified(model):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [predict(model.value, text) for (text,) in lists(rows, "text")]
            languages, scores = [x for x, _ in found], [x for _, x in found]
            yield batch(PREDICTED, [rows.column("doc_id"), rows.column("held_out"), languages, scores])

    return identify


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The score is the calibrated probability of the language. A null text, one without a letter, or any text
    where there was nothing to learn from is `und`, with score 0. Null ids stay null and are not
    held out. Repeated rows get equal results. Other columns are ignored.
    """
    source = docs.select(
        docs["doc_id"].cast(LongType()).alias("doc_id"), held_out(docs["doc_id"].cast(LongType())).alias("held_out"), docs["text"]
    )
    return source.mapInArrow(_identified(docs.sparkSession.sparkContext.broadcast(model)), PREDICTED)
