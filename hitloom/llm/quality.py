"""Quality scores by regularised quadratic discriminant analysis.

A document becomes a vector of transformed statistics of its text. Each class has a
mean and a covariance shrunk twice: towards the covariance of both classes (``pooled``)
and towards a multiple of the identity (``round``). The score is the difference of the
two log densities, from squared Mahalanobis distances through cached Cholesky factors,
turned into a probability by a logistic fit on rows kept out of the fit.

Null and empty texts have statistics of zero and are scored like any other. Repeated
rows are scored each. If the labels hold fewer than two classes, or under ten rows of
one, every score is the share of label 1, or 0.5 without labels. Other columns are kept
out of the result unless ``keep`` names them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.llm.labelled import bounded_labels, one_text_per_id
from hitloom.llm.tables import bounded_slices, in_arrow, row_texts, rows_with_text, texts_of

FOLDS, REMAINDER = 5, 0
MOST_LABELLED = 20_000
THRESHOLD = 0.3

# Classes of bytes; bytes over 127 belong to letters outside ASCII.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = 1
_KINDS[33:127] = 2
_KINDS[list(b".,")] = 3
_KINDS[list(b"0123456789")] = 4
_KINDS[65:91] = 5
_KINDS[97:123] = 6
_KINDS[0xC0:] = 6
_N_KINDS = 7
N_STATISTICS = 11


def statistics(texts: list[str]) -> np.ndarray:
    """One row of transformed statistics per text."""
    packed = [text.encode() for text in texts]
    ends = np.cumsum([0, *map(len, packed)])
    kinds = _KINDS[np.frombuffer(b"".join(packed), np.uint8)]
    counts = np.zeros((len(texts), _N_KINDS))
    full = np.flatnonzero(ends[1:] > ends[:-1])
    if len(full):
        for kind in range(1, _N_KINDS):
            # The starts of the texts that have bytes bound their sums.
            counts[full, kind] = np.add.reduceat(kinds == kind, ends[full], dtype=np.int64)
    _, _, symbols, stops, digits, capitals, small = counts.T
    letters = capitals + small
    shown = np.maximum(1, letters + symbols + stops + digits)
    words = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        split = text.split()
        if split:
            seen = Counter(split)
            words[i] = (len(split), len(seen), max(seen.values()), sum(map(eq, split, split[1:])))
    n, distinct, commonest, repeats = words.T
    some = np.maximum(1, n)
    return np.stack([
        np.log1p(n),
        np.log1p(shown / some),
        np.sqrt(symbols / shown),
        np.sqrt(stops / some),
        np.sqrt(digits / shown),
        np.sqrt(capitals / np.maximum(1, letters)),
        np.log1p(distinct) / np.log1p(some),
        np.sqrt(commonest / some),
        np.sqrt(repeats / some),
        np.log1p(symbols),
        np.sqrt(counts[:, 1] / np.maximum(1, shown)),
    ], axis=1)


@dataclass
class QualityModel:
    """Standardising shift and scale, class means and factors, and the logistic fit."""

    shift: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray] = field(default_factory=list)
    whiten: list[np.ndarray] = field(default_factory=list)
    log_det: list[float] = field(default_factory=list)
    slope: float = 0.0
    offset: float = 0.0

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log density under label 1 less that under label 0."""
        x = (rows - self.shift) / self.scale
        logs = [-0.5 * (((x - mean) @ whiten) ** 2).sum(axis=1) - 0.5 * det
                for mean, whiten, det in zip(self.means, self.whiten, self.log_det, strict=True)]
        return logs[1] - logs[0] if logs else np.zeros(len(rows))

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.slope * _squeezed(self.difference(rows)) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _squeezed(difference: np.ndarray) -> np.ndarray:
    """Far from both classes log densities differ by hundreds; the logistic fit needs less."""
    return np.arcsinh(difference)


def discriminant(rows: np.ndarray, labels: np.ndarray, pooled: float, round_: float,
                 ) -> QualityModel:
    """Class means and shrunk covariances as whitening matrices."""
    scale = rows.std(axis=0)
    model = QualityModel(rows.mean(axis=0), np.where(scale > 1e-9, scale, 1.0))
    x = (rows - model.shift) / model.scale
    sides = [x[labels == k] for k in (0, 1)]
    model.means = [side.mean(axis=0) for side in sides]
    scatter = [(side - mean).T @ (side - mean) for side, mean in zip(sides, model.means,
                                                                    strict=True)]
    common = sum(scatter) / len(x)
    eye = np.eye(x.shape[1])
    for s, side in zip(scatter, sides, strict=True):
        cov = (1 - pooled) * s / len(side) + pooled * common
        cov = (1 - round_) * cov + round_ * max(np.trace(cov) / len(cov), 1e-6) * eye
        lower = np.linalg.cholesky(cov)
        model.whiten.append(np.linalg.inv(lower).T)
        model.log_det.append(2 * float(np.log(np.diag(lower)).sum()))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a weak pull towards zero."""
    features = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(2)
        beta += np.linalg.solve(hessian, features.T @ (y - p) - 1e-2 * beta)
    return float(beta[0]), float(beta[1])


def train_model(rows: np.ndarray, labels: np.ndarray,
                grid: Sequence[float] = (0.01, 0.1, 0.3)) -> QualityModel:
    """Chooses both shrinkages by log loss on every fifth row, which also fit the logistic."""
    ones = int(labels.sum()) if len(labels) else 0
    if min(ones, len(labels) - ones) < 10:
        share = ones / len(labels) if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(np.zeros(N_STATISTICS), np.ones(N_STATISTICS),
                            offset=float(np.log(share / (1 - share))))
    order = np.random.default_rng(7).permutation(len(rows))
    rows, labels = rows[order], labels[order]
    check = np.zeros(len(rows), dtype=bool)
    for label in (0, 1):
        check[np.flatnonzero(labels == label)[::5]] = True
    best, best_loss = None, np.inf
    for pooled in grid:
        for round_ in grid:
            model = discriminant(rows[~check], labels[~check], pooled, round_)
            squeezed = _squeezed(model.difference(rows[check]))
            model.slope, model.offset = _logistic(squeezed, labels[check])
            p = np.clip(model.score(rows[check]), 1e-9, 1 - 1e-9)
            loss = -np.log(np.where(labels[check] == 1, p, 1 - p)).mean()
            if loss < best_loss:
                best, best_loss = model, loss
    return best


def fit(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, remainder: int = REMAINDER,
        bound: int = MOST_LABELLED) -> QualityModel:
    """Trains on at most ``bound`` labelled documents outside the held-out fold, one text for
    each id, whatever rows share it."""
    chosen = bounded_labels(labels, "quality", None, folds, remainder, bound)
    sample = one_text_per_id(documents.select("doc_id", "text")
                             .join(F.broadcast(chosen), "doc_id"), "label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(statistics(texts_of(batch.column(1)))),
                                           pa.list_(pa.float64())), batch.column(2)],
                names=["doc_id", "statistics", "label"])

    kinds = f"doc_id {dict(sample.dtypes)['doc_id']}, statistics array<double>, label int"
    # In one order, as training draws by place.
    table = in_arrow(sample, measure, kinds).toArrow().sort_by("doc_id")
    rows = table["statistics"].combine_chunks().flatten().to_numpy().reshape(-1, N_STATISTICS)
    return train_model(rows, table["label"].to_numpy().astype(np.int64))


def score_rows(documents: DataFrame, model: QualityModel, text: str = "text",
               keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row``, a struct of the columns to keep, and ``score`` of every whole text."""
    kept = rows_with_text(documents, text, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = row_texts(batch, text)
            scores = [model.score(statistics(texts[some])) for some in bounded_slices(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([*scores, np.empty(0)]))],
                names=["row", "score"])

    return in_arrow(kept, run, T.StructType([kept.schema["row"],
                                              T.StructField("score", T.DoubleType())]))


def score_documents(documents: DataFrame, model: QualityModel, text: str = "text",
                    keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` of every whole text."""
    return score_rows(documents, model, text, keep).select("row.*", "score")
