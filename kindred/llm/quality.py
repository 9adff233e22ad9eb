"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of transformed statistics. Per class the mean and the
covariance come from sums over all labelled rows of the training folds; covariances are
shrunk towards the covariance common to the classes and towards its diagonal. A score is the
logistic of the difference of the classes' log densities (Mahalanobis distances through
cached Cholesky factors) and log priors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm.features import SPACE, text_bytes, words_of
from kindred.llm.folds import held_out, training_labels
from kindred.llm.slices import map_slices

NAMES = (
    "log_words", "word_length", "upper", "symbols", "digits", "distinct", "repeats", "closed",
    "bare_symbols", "line_words", "distinct_lines", "top_word", "short_words",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = ~(_LETTER | _DIGIT | SPACE)
_CLOSING = np.zeros(256, bool)
_CLOSING[[ord(c) for c in ".,;:?"]] = True


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share, smoothed so that none of a few says little."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Square root of a smoothed share; its spread depends little on the share."""
    return np.sqrt((part + 0.1) / (whole + 1.0))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; a text without words has the values of no evidence."""
    texts = len(column)
    data, starts = text_bytes(column)
    words = words_of(column)
    sizes = np.diff(starts)
    row_of = np.repeat(np.arange(texts), sizes)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row_of[mask], minlength=texts).astype(float)

    def per_word_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(words.rows[mask], minlength=texts).astype(float)

    count = words.per_text().astype(float)
    letters = per_text(_LETTER[data])
    filled = per_text(~SPACE[data])
    hashes = words.hashes()
    # distinct words and the share of the most frequent one: sort by (text, hash)
    order = np.lexsort((hashes, words.rows))
    rows, sorted_hashes = words.rows[order], hashes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (sorted_hashes[1:] != sorted_hashes[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(rows)))
    top = np.zeros(texts)
    np.maximum.at(top, rows[at], times)
    distinct = np.bincount(rows[at], minlength=texts).astype(float)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.rows[1:] == words.rows[:-1])
    last = data[words.ends - 1]
    symbol_so_far = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    bare = symbol_so_far[words.ends] - symbol_so_far[words.starts] == words.sizes
    # lines, by the sum of the hashes of their words
    line_of = np.concatenate([[0], np.cumsum(data == 10)])[words.starts] if len(data) else hashes
    new_line = np.ones(len(words.rows), bool)
    new_line[1:] = (line_of[1:] != line_of[:-1]) | (words.rows[1:] != words.rows[:-1])
    line_at = np.flatnonzero(new_line)
    lines = np.bincount(words.rows[line_at], minlength=texts).astype(float)
    if len(line_at):
        sums = np.add.reduceat(hashes, line_at)
        pairs = np.unique(np.stack([words.rows[line_at].astype(np.uint64), sums]), axis=1)
        distinct_lines = np.bincount(pairs[0].astype(np.int64), minlength=texts).astype(float)
    else:
        distinct_lines = np.zeros(texts)
    return np.stack([
        np.log1p(count),
        np.log((filled + 5.0) / (count + 1.0)),
        _share(per_text(_UPPER[data]), letters),
        _share(per_text(_SYMBOL[data]), filled),
        _share(per_text(_DIGIT[data]), filled),
        np.log((distinct + 1.0) / (count + 1.0)),
        _share(per_word_text(again), count),
        _share(per_word_text(_CLOSING[last]), count),
        _share(per_word_text(bare), count),
        np.log((count + 1.0) / (lines + 1.0)),
        np.log((distinct_lines + 1.0) / (lines + 1.0)),
        _share(top, count),
        _share(per_word_text(words.sizes <= 3), count),
    ], axis=1)


@dataclass(frozen=True)
class Moments:
    """Count, sum and sum of outer products of the vectors of one class."""

    count: float
    total: np.ndarray
    outer: np.ndarray

    def mean(self) -> np.ndarray:
        return self.total / self.count

    def scatter(self) -> np.ndarray:
        return self.outer - np.outer(self.total, self.total) / self.count


@dataclass(frozen=True)
class ClassDensity:
    """A Gaussian by its mean and the inverse Cholesky factor of its covariance."""

    mean: np.ndarray
    whiten: np.ndarray
    offset: float

    @classmethod
    def fit(cls, mean: np.ndarray, covariance: np.ndarray, prior: float) -> ClassDensity:
        factor = np.linalg.cholesky(covariance)
        return cls(mean, np.linalg.inv(factor),
                   float(np.log(prior) - np.log(np.diag(factor)).sum()))

    def log_density(self, vectors: np.ndarray) -> np.ndarray:
        """Up to a constant common to the classes."""
        return self.offset - 0.5 * (((vectors - self.mean) @ self.whiten.T) ** 2).sum(axis=1)


@dataclass(frozen=True)
class Model:
    """Densities of both classes, or the constant score if one of them has no example."""

    low: ClassDensity | None
    high: ClassDensity | None
    constant: float

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(vectors), self.constant)
        difference = self.high.log_density(vectors) - self.low.log_density(vectors)
        return 1.0 / (1.0 + np.exp(-np.clip(difference, -500, 500)))


def discriminant(
    low: Moments, high: Moments, shrink_common: float = 0.1, shrink_diagonal: float = 0.05,
) -> Model:
    """Shrunken covariances: ``(1 - a - b) own + a common + b diag(common)``, plus a ridge."""
    total = low.count + high.count
    if not low.count or not high.count:
        return Model(None, None, high.count / total if total else 0.5)
    common = (low.scatter() + high.scatter()) / total
    diagonal = np.diag(np.diag(common) + 1e-6)

    def density(part: Moments) -> ClassDensity:
        own = part.scatter() / part.count
        covariance = (
            (1 - shrink_common - shrink_diagonal) * own + shrink_common * common
            + shrink_diagonal * diagonal + 1e-6 * np.eye(len(own))
        )
        return ClassDensity.fit(part.mean(), covariance, part.count / total)

    return Model(density(low), density(high), 0.5)


def labelled_vectors(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``vector, label`` of every labelled text of the training folds.

    Only the short vectors are shuffled to their labels, the texts are not. That shuffle
    stays when the labels are few enough to broadcast: without it the step that measures
    and the one that reads the vectors share a stage, so that a task holds two workers, and
    idle ones stay with the executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(part: pa.RecordBatch) -> pa.RecordBatch:
        vectors = statistics(part.column(1))
        return pa.record_batch({
            id_col: part.column(0), "vector": pa.array(list(vectors), pa.list_(pa.float64())),
        })

    found = training_labels(labels, label, id_col).hint("merge")
    return map_slices(
        docs.where(~held_out(id_col)).select(id_col, text_col), text_col, measure,
        f"`{id_col}` {kind}, vector array<double>",
    ).join(found, id_col).select("vector", "label")


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit on every labelled text of the training folds; nothing is sampled.

    A task adds up the moments of its texts per class; the driver sees one row per task
    and class. A text whose id is labelled counts as often as it is repeated. Without
    labels every score is 0.5, with one class alone it is the share of label 1.
    """
    width = len(NAMES)
    rows = labelled_vectors(docs, labels, label, id_col, text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            vectors = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            positive = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for number, mask in enumerate((~positive, positive)):
                own = vectors[mask]
                sums[number] += np.concatenate(
                    [[len(own)], own.sum(axis=0), (own.T @ own).ravel()]
                )
        yield pa.record_batch({
            "label": pa.array([0, 1], pa.int32()),
            "sums": pa.array(sums.tolist(), pa.list_(pa.float64())),
        })

    totals = np.zeros((2, 1 + width + width * width))
    for row in rows.mapInArrow(task, "label int, sums array<double>").collect():
        totals[row["label"]] += np.array(row["sums"])
    low, high = (
        Moments(values[0], values[1 : width + 1], values[width + 1 :].reshape(width, width))
        for values in totals
    )
    return discriminant(low, high)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of each text.

    One row per row of ``docs``; all its columns stay, but columns named ``score`` or
    ``predicted`` are replaced. Null and empty texts are scored as texts without a word.
    """
    kept = [name for name in docs.columns if name not in ("score", "predicted")]
    at = kept.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema
                       if f.name in kept)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        values = model.scores(statistics(part.column(at)))
        columns = {name: part.column(number) for number, name in enumerate(kept)}
        return pa.record_batch(columns | {
            "score": pa.array(values, pa.float64()),
            "predicted": pa.array((values >= threshold).astype(np.int32), pa.int32()),
        })

    return map_slices(
        docs.select(*kept), text_col, run, f"{fields}, score double, predicted int"
    )
