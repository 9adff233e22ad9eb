"""Toxicity by non-negative positive-unlabelled learning.

Training sees confirmed toxic texts (P) and texts without any label (U). With the class
prior ``pi`` the risk of a classifier is

    pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))

where R_X(s) is the mean loss of treating the texts of X as class s. The second term
estimates the risk on clean texts; where it falls below zero the step goes back up
instead, which keeps the classifier from fitting U as if it were clean.

A text's features are its distinct words and the first bytes of its words, hashed to
buckets. Of these only buckets are used that are significantly more frequent in P than
in U, so rare words cannot decide. The linear model is trained in numpy on a bounded
sample; scoring passes over every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.features import words_of
from kindred.llm.folds import held_out, smallest_hashes, training_labels
from kindred.llm.slices import map_slices
from kindred.session import local_table

#: Hash buckets of the features, as a power of two.
BUCKET_BITS = 24
#: Word prefixes (bytes) that are features beside the whole word.
PREFIXES = (4, 5)


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample, in texts."""

    positives: int = 2_000
    unlabelled: int = 5_000
    #: labelled clean texts of the training folds, for the scale of the scores alone
    calibration: int = 2_000


@dataclass(frozen=True)
class Model:
    """Weights of the chosen buckets, in ascending bucket order, and the scale of the scores."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    scale: float
    shift: float

    def scores(self, rows: np.ndarray, buckets: np.ndarray, texts: int) -> np.ndarray:
        """Score of each text, from (text, bucket) features in any order."""
        return _logistic(self.scale * self.margins(rows, buckets, texts) + self.shift)

    def margins(self, rows: np.ndarray, buckets: np.ndarray, texts: int) -> np.ndarray:
        rows, at = _chosen(rows, buckets, self.buckets)
        found = np.bincount(rows, minlength=texts)
        summed = np.bincount(rows, self.weights[at], minlength=texts)
        return summed / np.sqrt(np.maximum(found, 1)) + self.bias


def _logistic(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -500, 500)))


def _chosen(rows, buckets, chosen) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, position in ``chosen``) of the features that are in ``chosen``."""
    if not len(chosen) or not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mark = np.zeros(1 << 16, bool)  # most features are ruled out by their low bits
    mark[chosen & 0xFFFF] = True
    near = mark[buckets & 0xFFFF]
    rows, buckets = rows[near], buckets[near]
    at = np.minimum(np.searchsorted(chosen, buckets), len(chosen) - 1)
    same = chosen[at] == buckets
    pairs = np.unique(rows[same].astype(np.int64) * len(chosen) + at[same])
    return pairs // len(chosen), pairs % len(chosen)


def features_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of every word and word prefix, repeats included."""
    words = words_of(column, letters_only=True)
    buckets = []
    for number, first in enumerate((None, *PREFIXES)):
        salt = np.uint64(0x9E3779B97F4A7C15 * number & 0xFFFFFFFFFFFFFFFF)
        buckets.append((words.hashes(first) ^ salt) >> np.uint64(64 - BUCKET_BITS))
    return np.tile(words.rows, len(buckets)), np.concatenate(buckets).astype(np.int64)


def _collect(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str):
    """Features of the chosen texts: their roles, and distinct (text, bucket) pairs."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows, buckets = features_of(part.column(1))
        pairs = np.unique(rows << BUCKET_BITS | buckets)
        edges = np.searchsorted(pairs >> BUCKET_BITS, np.arange(part.num_rows + 1))
        packed = (pairs & (1 << BUCKET_BITS) - 1).astype("<u4").tobytes()
        return pa.record_batch({
            "role": part.column(0),
            "buckets": pa.array([packed[4 * a : 4 * b] for a, b in zip(edges, edges[1:], strict=False)],
                                pa.binary()),
        })

    # the ids are at most as many as the sample, so broadcasting them is bounded
    sample = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select("role", text_col)
    found = map_slices(sample, text_col, run, "role string, buckets binary").toArrow()
    roles = np.array(found["role"].to_pylist(), object)
    arrays = [np.frombuffer(value, "<u4") for value in found["buckets"].to_pylist()]
    rows = np.repeat(np.arange(len(arrays)), [len(values) for values in arrays])
    return roles, rows, np.concatenate([*arrays, np.empty(0, np.uint32)]).astype(np.int64)


def _select(positive, unlabelled, buckets_p, buckets_u, threshold: float) -> np.ndarray:
    """Buckets with a larger share of P than of U whose likelihood ratio statistic (G)
    reaches ``threshold``; unlike a normal approximation it holds for small counts too."""
    keys, in_p = np.unique(buckets_p, return_counts=True)
    others, count_u = np.unique(buckets_u, return_counts=True)
    in_u = np.zeros(len(keys))
    if len(others):
        at = np.minimum(np.searchsorted(others, keys), len(others) - 1)
        in_u = np.where(others[at] == keys, count_u[at], 0)
    pooled = (in_p + in_u) / (positive + unlabelled)

    def gain(count, size, share):  # count * log(count / expected), 0 for no count
        return np.where(count > 0, count * np.log(np.maximum(count, 1) / (size * share)), 0.0)

    rest = np.maximum(1 - pooled, 1e-12)
    statistic = 2 * (
        gain(in_p, positive, pooled) + gain(in_u, unlabelled, pooled)
        + gain(positive - in_p, positive, rest) + gain(unlabelled - in_u, unlabelled, rest)
    )
    return keys[(in_p / positive > in_u / unlabelled) & (statistic >= threshold)]


def fit_weights(
    p: tuple[np.ndarray, np.ndarray, int], u: tuple[np.ndarray, np.ndarray, int], size: int,
    prior: float, steps: int = 200, rate: float = 0.2, penalty: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk with logistic loss by full-batch Adam.

    ``p`` and ``u`` are (text, feature, number of texts) with distinct features per text.
    """
    def prepared(part):
        rows, features, texts = part
        value = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=texts), 1))
        return rows, features, value[rows], texts

    p, u = prepared(p), prepared(u)
    weights, bias = np.zeros(size), np.log(prior / (1 - prior))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        margin_p, margin_u = (
            np.bincount(rows, weights[features] * value, minlength=texts) + bias
            for rows, features, value, texts in (p, u)
        )
        clean_risk = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
        if clean_risk >= 0:
            slope_p = np.full(p[3], -prior / p[3])  # of pi R_P(+) and of - pi R_P(-) together
            slope_u = _logistic(margin_u) / u[3]
        else:  # climb out of the negative estimate
            slope_p = prior * _logistic(margin_p) / p[3]
            slope_u = -_logistic(margin_u) / u[3]
        gradient = np.zeros(size + 1)
        for (rows, features, value, _), slope in ((p, slope_p), (u, slope_u)):
            gradient[:size] += np.bincount(features, slope[rows] * value, minlength=size)
            gradient[size] += slope.sum()
        gradient[:size] += penalty * weights
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:size], bias - move[size]
    return weights, float(bias)


def _calibrate(margins: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float]:
    """Scale and shift that make the logistic of a margin a probability (Newton steps)."""
    share = positive.mean()
    weight = np.where(positive, prior / share, (1 - prior) / (1 - share))
    weight /= weight.sum()
    # targets short of 0 and 1 keep the scale finite when the classes part completely
    target = np.where(positive, 1 - 1e-3, 1e-3)
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    found = np.array([1.0, -float(np.median(margins))])
    for _ in range(60):
        chance = _logistic(design @ found)
        slope = design.T @ (weight * (chance - target)) + 1e-6 * found
        curve = design.T * (weight * np.maximum(chance * (1 - chance), 1e-6)) @ design
        move = np.linalg.solve(curve + 1e-6 * np.eye(2), slope)
        found = found - move / max(1.0, np.abs(move).max())
    return float(found[0]), float(found[1])


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", sample: Sample = Sample(), threshold: float = 24.0,
) -> Model:
    """A classifier from the labels of the training folds.

    P: texts with a positive label. U: texts of the training folds, whatever their labels.
    The class prior is the share of positive labels. Clean labels serve only to scale the
    scores, so that 0.5 separates the classes. Samples are the ids with the smallest
    hashes. Without any positive label, or without texts for them, the model gives every
    text the prior.
    """
    found = training_labels(labels, label, id_col)
    # the labels that have a text, or else sampled ids might name texts that are gone
    found = found.join(docs.select(id_col), id_col, "left_semi")
    count = {row["label"]: row["count"] for row in found.groupBy("label").count().collect()}
    labelled = sum(count.values())
    prior = sum(n for value, n in count.items() if value > 0) / labelled if labelled else 0.0
    constant = Model(np.empty(0, np.int64), np.empty(0), 0.0, 0.0,
                     float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    if not 0 < prior < 1:
        return constant
    positives = smallest_hashes(found.where("label > 0"), sample.positives, id_col)
    clean = smallest_hashes(found.where("label <= 0"), sample.calibration, id_col)
    unlabelled = smallest_hashes(docs.where(~held_out(id_col)), sample.unlabelled, id_col)
    rows = [*((i, "p") for i in positives), *((i, "n") for i in clean), *((i, "u") for i in unlabelled)]
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = local_table(docs.sparkSession, rows, f"`{id_col}` {kind}, role string")
    roles, texts, buckets = _collect(docs, chosen, id_col, text_col)

    def part(role: str) -> tuple[np.ndarray, np.ndarray, int]:
        here = np.flatnonzero(roles == role)
        place = np.full(len(roles), -1)
        place[here] = np.arange(len(here))
        mask = roles[texts] == role
        return place[texts[mask]], buckets[mask], len(here)

    p, u, n = part("p"), part("u"), part("n")
    keys = _select(p[2], u[2], p[1], u[1], threshold)
    if not len(keys):
        return constant
    weights, bias = fit_weights(
        *((*_chosen(rows, found, keys), size) for rows, found, size in (p, u)), len(keys), prior
    )
    model = Model(keys, weights, bias, 1.0, 0.0)
    margins = [model.margins(*each) for each in (p, n)]
    if not n[2]:
        return model
    positive = np.repeat([True, False], [p[2], n[2]])
    scale, shift = _calibrate(np.concatenate(margins), positive, prior)
    return Model(keys, weights, bias, scale, shift)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.5,
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
        values = model.scores(*features_of(part.column(at)), part.num_rows)
        columns = {name: part.column(number) for number, name in enumerate(kept)}
        return pa.record_batch(columns | {
            "score": pa.array(values, pa.float64()),
            "predicted": pa.array((values >= threshold).astype(np.int32), pa.int32()),
        })

    return map_slices(
        docs.select(*kept), text_col, run, f"{fields}, score double, predicted int"
    )
