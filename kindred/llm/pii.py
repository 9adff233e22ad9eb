"""Personal data by aggregating weak supervision.

Four base kinds (email, ip, card, phone) are fixed by their patterns. The method adds
secrets: keys, tokens and passwords in running text. Candidates are long runs of letters
and digits; labelers vote on each of them or abstain: patterns of known key formats and of
hexadecimal digests, a gazetteer of words that announce a secret, the context of
assignments, quotes and addresses, and the mixture of characters. Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is and
how probable each pattern is a secret; a logistic classifier of span features, trained on
these probabilities, has the last word. All counts are taken over the whole table and
have a bounded number of distinct rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.slices import map_slices, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

_DIGIT = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match cannot begin within a run of digits: from there the same text would follow
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Words that announce a secret.
GAZETTEER = (
    "password", "passwd", "pwd", "passphrase", "token", "secret", "api_key", "apikey", "api key",
    "access_key", "private_key", "client_secret", "auth", "bearer", "credential",
)
_ANNOUNCED = re.compile("|".join(map(re.escape, GAZETTEER)), re.IGNORECASE)
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}")
_KEY_FORMAT = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}"
    r"|sk-[0-9A-Za-z]{20,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{16,}"
)
_HEXADECIMAL = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_ASSIGNED = re.compile(r"[=:]\s?[\"']?$|[\"']$")
_CHANGE = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])")
#: Characters before a candidate that its labelers see.
CONTEXT = 24
LABELERS = ("format", "hexadecimal", "gazetteer", "context", "mixture")
#: How often each labeler is taken to have been right and wrong before any data.
BEFORE = ((99, 1), (19, 1), (8, 2), (8, 2), (8, 2))
#: Length, share of digits and changes of character class, each in four bins.
BINS = 4


def luhn(digits: str) -> bool:
    """Whether the digits' checksum is right."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of email addresses: the run before each ``@`` and the domain after it."""
    found, done = [], 0
    mark = text.find("@")
    while mark >= 0:
        domain = _DOMAIN.match(text, mark + 1)
        start = mark
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < mark:
                done = domain.end()
                found.append((start, done))
        mark = text.find("@", max(mark + 1, done))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base kinds, by kind and then start."""
    spans = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for match in _IP.finditer(text):
        # parts of many digits are too large; they are not turned into numbers
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            spans.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _NO_DIGIT.sub("", match[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", match[0])) <= 15:
                spans.append((3, *match.span()))
    return spans


def _joined(spans) -> tuple[list[int], list[int]]:
    """Starts and ends of what ``spans`` cover, in order and apart from each other."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((a, b) for _, a, b in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _overlaps(start: int, end: int, covered: tuple[list[int], list[int]]) -> bool:
    """Whether ``start:end`` meets what is covered: of the stretches before ``end``, the last."""
    at = bisect_left(covered[0], end) - 1
    return at >= 0 and covered[1][at] > start


def candidates(text: str, known) -> list[tuple[int, int]]:
    """Spans that may be secrets: long runs with letters and digits, outside known spans."""
    if not _DIGIT.search(text):
        return []
    covered = _joined(known)
    return [
        match.span() for match in _CANDIDATE.finditer(text)
        if _DIGIT.search(match[0]) and not match[0].isdigit()
        and not _overlaps(*match.span(), covered)
    ]


def votes(text: str, start: int, end: int) -> tuple[int, ...]:
    """Each labeler's vote on a span: 1 secret, -1 none, 0 abstains."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start]
    line = before.rpartition("\n")[2]
    changes = len(_CHANGE.findall(span))
    if "://" in line or "www." in line or span.count("/") > 1:
        context = -1  # part of an address or a path
    else:
        context = int(bool(_ASSIGNED.search(line)))
    return (
        1 if _KEY_FORMAT.fullmatch(span) else 0,
        1 if _HEXADECIMAL.fullmatch(span) and changes else 0,
        1 if _ANNOUNCED.search(line) else 0,
        context,
        1 if 5 * changes >= end - start else -int(changes <= 2),
    )


def bins(text: str, start: int, end: int) -> tuple[int, ...]:
    """Bins of length, share of digits and changes of character class."""
    span = text[start:end]
    digits = len(span) - len(_DIGIT.sub("", span))
    changes = len(_CHANGE.findall(span))
    return (
        min((end - start - 16) // 8, BINS - 1), min(BINS * digits // len(span), BINS - 1),
        min(BINS * 2 * changes // len(span), BINS - 1),
    )


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier, and what EM found about the labelers."""

    weights: np.ndarray
    prior: float
    reliability: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(rows) @ self.weights, -500, 500)))


def _design(rows: np.ndarray) -> np.ndarray:
    """Features of (votes, bins) rows: one column per vote value, per bin, and one for all."""
    count = len(LABELERS)
    parts = [rows[:, i : i + 1] == np.array([-1, 0, 1]) for i in range(count)]
    parts += [rows[:, i : i + 1] == np.arange(BINS) for i in range(count, rows.shape[1])]
    return np.concatenate([*parts, np.ones((len(rows), 1))], axis=1).astype(float)


def fit_labelers(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, before: tuple = BEFORE,
) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns: probability of each, class prior, reliability of each labeler.

    A labeler that votes is right with its own probability; abstaining says nothing. It is
    taken to have been right and wrong ``before`` as often as stated, so that the labelers
    keep their meaning where one class hardly occurs.
    """
    right, wrong = np.array(before, float).T
    voted = patterns != 0
    yes = patterns > 0
    belief = 1 / (1 + np.exp(-(patterns @ np.log(right / wrong))))
    for _ in range(rounds):
        prior = (counts @ belief + 1) / (counts.sum() + 2)
        agree = np.where(yes, belief[:, None], 1 - belief[:, None]) * voted
        reliability = (counts @ agree + right) / (counts @ voted + right + wrong)
        odds = patterns @ np.log(reliability / (1 - reliability)) + np.log(prior / (1 - prior))
        belief = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    return belief, float(prior), reliability


def fit_classifier(
    rows: np.ndarray, belief: np.ndarray, counts: np.ndarray, penalty: float = 1.0,
    rounds: int = 30,
) -> np.ndarray:
    """Logistic weights for soft labels, by damped Newton steps."""
    design, weights = _design(rows), np.zeros(_design(rows[:1]).shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        slope = design.T @ (counts * (chance - belief)) + penalty * weights
        curve = (design.T * (counts * chance * (1 - chance))) @ design
        move = np.linalg.solve(curve + penalty * np.eye(len(weights)), slope)
        weights = weights - move / max(1.0, np.abs(move).max() / 4)
    return weights


def train(docs: DataFrame, text_col: str = "text") -> Model | None:
    """Fit labelers and classifier on every candidate of the table; None without candidates."""
    fields = [*(f"v{i}" for i in range(len(LABELERS))), "b0", "b1", "b2"]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        counted: dict[tuple, int] = {}
        for text in texts_of(part.column(0)):
            for start, end in candidates(text, base_spans(text)):
                key = (*votes(text, start, end), *bins(text, start, end))
                counted[key] = counted.get(key, 0) + 1
        columns = list(zip(*counted, strict=True)) if counted else [[] for _ in fields]
        return pa.record_batch({
            **{name: pa.array(column, pa.int32()) for name, column in zip(fields, columns, strict=True)},
            "count": pa.array(counted.values(), pa.int64()),
        })

    found = map_slices(
        docs.select(text_col), text_col, run,
        ", ".join(f"{name} int" for name in fields) + ", count bigint",
    )
    # at most 3 ** labelers * BINS ** 3 rows, whatever the table
    table = found.groupBy(*fields).agg(F.sum("count").alias("count")).orderBy(*fields).toArrow()
    if not table.num_rows:
        return None
    rows = np.stack([table[name].to_numpy() for name in fields], axis=1)
    counts = table["count"].to_numpy().astype(float)
    belief, prior, reliability = fit_labelers(rows[:, : len(LABELERS)], counts)
    return Model(fit_classifier(rows, belief, counts), prior, reliability)


def all_spans(text: str, model: Model | None, threshold: float = 0.5) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of base spans and of the candidates that the classifier accepts."""
    spans = base_spans(text)
    found = candidates(text, spans) if model else []
    if found:
        rows = np.array([(*votes(text, a, b), *bins(text, a, b)) for a, b in found])
        good = model.probability(rows) >= threshold
        spans += [(4, a, b) for (a, b), keep in zip(found, good, strict=True) if keep]
    return spans


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_spans(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id, spans`` of every row: kind, start and end (exclusive) in code points.

    Spans are ordered by kind (``KINDS``) and start. A null or empty text has none, repeated
    rows stay, other columns are ignored, an empty table gives an empty result.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in all_spans(text, model)]
            for text in texts_of(part.column(1))
        ]
        return pa.record_batch({id_col: part.column(0), "spans": pa.array(spans, _SPANS)})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(id_col, text_col), text_col, run,
        f"`{id_col}` {kind}, spans array<struct<kind: string, start: int, end: int>>",
    )


def redacted(text: str, model: Model | None) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlaps become one."""
    spans = sorted(all_spans(text, model), key=lambda span: (span[1], -span[2]))
    pieces, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            pieces += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def redact(
    docs: DataFrame, model: Model | None, text_col: str = "text", length_col: str | None = None,
) -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; null texts stay null.

    ``length_col``, if given, is set to the new number of code points.
    """
    names = docs.columns
    at = names.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else redacted(t, model) for t in part.column(at).to_pylist()]
        columns = {name: part.column(number) for number, name in enumerate(names)}
        columns[text_col] = pa.array(texts, pa.string())
        return pa.record_batch(columns)

    result = map_slices(docs, text_col, run, fields)
    if length_col:
        kind = docs.schema[length_col].dataType
        changed = F.coalesce(F.length(text_col), F.lit(0)).cast(kind)
        result = result.withColumn(length_col, changed)
    return result


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
