"""Toxicity scores by non-negative positive-unlabelled learning.

Linear classifiers over the words of a text and the beginnings of its words are trained in numpy on confirmed toxic
documents and on unlabelled text. With the share ``prior`` of toxic documents in all
text, the risk is

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-)),

where R_p and R_u are mean logistic losses over toxic and unlabelled documents. The
second term estimates the risk on clean text; once a batch drives it below zero, the
step goes the other way, so that the classifier does not overfit the unlabelled text.

Null and empty texts have no words and get the bias alone. Repeated rows are scored
each. Without any confirmed toxic document every score is 0. Other columns are kept
out of the result unless ``keep`` names them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.llm.labelled import bounded_labels, held_out, one_text_per_id
from hitloom.llm.tables import in_arrow, row_texts, rows_with_text, texts_of, written

FOLDS, REMAINDER = 4, 2
MOST_POSITIVE = 8_000
MOST_UNLABELLED = 16_000
THRESHOLD = 0.3
#: A feature of fewer documents is not told.
LEAST_DOCUMENTS = 5

_WORD = re.compile(r"[^\W\d_]+")


#: Inflected words share their beginning; these many letters of it count as features.
BEGINNINGS = (4, 5, 6)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: Iterable[str]) -> set[str]:
    """The words, and beginnings of longer words marked by a hyphen."""
    features = set(words)
    for n in BEGINNINGS:
        features.update([word[:n] + "-" for word in words if len(word) > n])
    return features


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        found = self.weights.keys() & features_of(words_of(text))
        z = self.bias + sum(map(self.weights.__getitem__, found))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class _Rows:
    """Documents as sets of word numbers, in flat arrays."""

    def __init__(self, documents: list[np.ndarray]):
        self.flat = np.concatenate([*documents, np.empty(0, np.int64)]).astype(np.int64)
        self.ends = np.cumsum([0, *map(len, documents)])

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the chosen documents and for each the place of its document."""
        starts, sizes = self.ends[chosen], self.ends[chosen + 1] - self.ends[chosen]
        place = np.repeat(np.arange(len(chosen)), sizes)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[np.repeat(starts, sizes) + within], place


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_nnpu(positive: _Rows, unlabelled: _Rows, n_words: int, prior: float, seed: int,
               least_steps: int = 400, epochs: int = 12, batch: int = 1000, rate: float = 0.05,
               decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam in minibatches."""
    rng = np.random.default_rng(seed)
    w = np.zeros(n_words + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    n_p, n_u = len(positive.ends) - 1, len(unlabelled.ends) - 1
    for _ in range(max(epochs, -(-least_steps // -(-n_u // batch)))):
        order = rng.permutation(n_u)
        for start in range(0, n_u, batch):
            u = order[start : start + batch]
            p = rng.integers(0, n_p, max(1, batch // 3))
            word_p, doc_p = positive.take(p)
            word_u, doc_u = unlabelled.take(u)
            z_p = np.bincount(doc_p, w[word_p], len(p)) + w[-1]
            z_u = np.bincount(doc_u, w[word_u], len(u)) + w[-1]
            clean = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
            g_u, g_p = _sigmoid(z_u) / len(u), prior * _sigmoid(z_p) / len(p)
            if clean >= 0:
                # d/dz of the losses: sigmoid(z) for the clean, -sigmoid(-z) for the toxic.
                g_p = -prior * _sigmoid(-z_p) / len(p) - g_p
            else:
                g_u = -g_u
            grad = (np.bincount(word_p, g_p[doc_p], n_words + 1)
                    + np.bincount(word_u, g_u[doc_u], n_words + 1))
            grad[-1] += g_p.sum() + g_u.sum()
            grad[:-1] += decay * w[:-1]
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad**2
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _telling(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, least: int,
             z_least: float = 5.0) -> np.ndarray:
    """Features whose share of toxic documents departs from that of all by ``z_least``
    standard errors; among tens of thousands chance alone reaches four."""
    share_p, share_u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    error = np.sqrt(share_u * (1 - share_u) * (1 / n_p + 1 / n_u))
    return (np.abs(share_p - share_u) >= z_least * error) & (in_p + in_u >= least)


def count_features(documents: Iterable[Iterable[str]]) -> Counter:
    """How many of the documents, given by their distinct words, have a feature."""
    counts: Counter = Counter()
    for words in documents:
        counts.update(features_of(words))
    return counts


def _numbered(words: Iterable[str], numbers: dict[str, int]) -> np.ndarray:
    """The numbers of a document's features, in order; those without one are left out."""
    found = numbers.keys() & features_of(words)
    return np.array(sorted(map(numbers.__getitem__, found)), np.int64)


def mean_model(positive: _Rows, unlabelled: _Rows, names: Sequence[str], prior: float,
               seeds: Sequence[int] = (1, 2, 3)) -> ToxicityModel:
    """The mean of one classifier per seed."""
    prior = min(max(prior, 1e-3), 0.5)
    runs = [train_nnpu(positive, unlabelled, len(names), prior, seed) for seed in seeds]
    mean = np.mean([w for w, _ in runs], axis=0)
    weights = {word: float(mean[i]) for i, word in enumerate(names) if abs(mean[i]) > 1e-6}
    return ToxicityModel(weights, float(np.mean([b for _, b in runs])))


def train_model(positive: Callable[[], Iterable[Sequence[str]]],
                unlabelled: Callable[[], Iterable[Sequence[str]]], prior: float,
                seeds: Sequence[int] = (1, 2, 3),
                least_documents: int = LEAST_DOCUMENTS) -> ToxicityModel:
    """``fit`` for documents at hand, as their distinct words, which are gone through twice:
    to count features and to keep the telling ones."""
    sides = (positive, unlabelled)
    counts = [count_features(documents()) for documents in sides]
    sizes = [sum(1 for _ in documents()) for documents in sides]
    if not min(sizes):
        return ToxicityModel({}, -30.0)
    names = sorted(counts[0].keys() | counts[1].keys())
    telling = _telling(*(np.fromiter(map(count.__getitem__, names), np.int64, len(names))
                         for count in counts), *sizes, least_documents)
    names = [name for name, kept in zip(names, telling, strict=True) if kept]
    numbers = {name: i for i, name in enumerate(names)}
    rows = [_Rows([_numbered(words, numbers) for words in documents()]) for documents in sides]
    return mean_model(*rows, names, prior, seeds)


def telling_features(documents: DataFrame, n_toxic: int, n_drawn: int,
                     least_documents: int = LEAST_DOCUMENTS) -> list[str]:
    """The telling features of (words, toxic, drawn) in code-point order, counted and chosen
    by the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, *marks = (batch[name].to_pylist() for name in ("words", "toxic", "drawn"))
            counts = [count_features(text.split() for text, mark in zip(texts, side, strict=True)
                                     if mark) for side in marks]
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 *(pa.array([each[name] for name in names], pa.int64()) for each in counts)],
                names=["feature", "in_toxic", "in_drawn"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _telling(*(batch[name].to_numpy() for name in ("in_toxic", "in_drawn")),
                            n_toxic, n_drawn, least_documents)
            yield batch.select(["feature"]).filter(pa.array(kept, pa.bool_()))

    counted = (
        in_arrow(documents.select("words", "toxic", "drawn"), count,
                 "feature string, in_toxic bigint, in_drawn bigint")
        .groupBy("feature").agg(F.sum("in_toxic").alias("in_toxic"),
                                F.sum("in_drawn").alias("in_drawn"))
    )
    return sorted(row.feature for row in in_arrow(counted, choose, "feature string").collect())


def fit(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, remainder: int = REMAINDER,
        most_positive: int = MOST_POSITIVE,
        most_unlabelled: int = MOST_UNLABELLED) -> ToxicityModel:
    """Trains on at most ``most_positive`` confirmed toxic documents and about
    ``most_unlabelled`` of all documents, both outside the held-out fold and one text for
    each id, whatever rows share it.

    The driver gets the telling features and their numbers in each document, no words.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", folds, remainder))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    toxic = bounded_labels(labels, "toxic", 1, folds, remainder, most_positive)
    share = min(1.0, most_unlabelled / max(1, documents.count()))
    pool = documents.select("doc_id", "text").where(~held_out("doc_id", folds, remainder))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1 << 30)) < int(share * 2**30)
    sample = one_text_per_id(
        pool.join(F.broadcast(toxic), "doc_id", "left")
        .select("doc_id", "text", (F.col("label") == 1).alias("toxic"), drawn.alias("drawn"))
        .where(F.col("toxic").isNotNull() | F.col("drawn")), "toxic", "drawn")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [" ".join(words_of(text)) for text in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), *batch.columns[2:]],
                names=["doc_id", "words", "toxic", "drawn"])

    key = f"doc_id {dict(sample.dtypes)['doc_id']}"
    # Stored, as the words are gone through twice.
    stored = written(in_arrow(sample, words, f"{key}, words string, toxic boolean, drawn boolean"),
                     "toxicity-words")
    sizes = stored.agg(F.count_if("toxic"), F.count_if("drawn")).first()
    if not min(sizes):
        return ToxicityModel({}, -30.0)
    names = telling_features(stored, *sizes)
    shared = documents.sparkSession.sparkContext.broadcast(
        {name: i for i, name in enumerate(names)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_numbered(text.split(), shared.value) for text in texts_of(batch["words"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.list_(pa.int32())), batch["toxic"],
                 batch["drawn"]], names=["doc_id", "features", "toxic", "drawn"])

    # In one order, as training goes through the rows by place.
    table = in_arrow(stored, number,
                     f"{key}, features array<int>, toxic boolean, drawn boolean"
                     ).toArrow().sort_by("doc_id")

    def chosen(column: str) -> _Rows:
        some = table["features"].filter(table[column])
        return _Rows([row.values.to_numpy() for row in some])

    return mean_model(chosen("toxic"), chosen("drawn"), names, float(prior))


def score_rows(documents: DataFrame, model: ToxicityModel, text: str = "text",
               keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row``, a struct of the columns to keep, and ``score`` of every whole text."""
    kept = rows_with_text(documents, text, keep)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = list(map(shared.value.score, row_texts(batch, text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return in_arrow(kept, run, T.StructType([kept.schema["row"],
                                              T.StructField("score", T.DoubleType())]))


def score_documents(documents: DataFrame, model: ToxicityModel, text: str = "text",
                    keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` of every whole text."""
    return score_rows(documents, model, text, keep).select("row.*", "score")
