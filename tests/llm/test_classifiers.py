import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import quality, toxicity
from kindred.llm.features import words_of
from kindred.llm.folds import held_out
from kindred.llm.queries import QUERIES
from kindred.session import materialise

FOLDER = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"


def area(scores, positive):
    """Chance that a positive scores above a negative, ties count half."""
    scores, positive = np.asarray(scores), np.asarray(positive, bool)
    a, b = scores[positive][:, None], scores[~positive][None, :]
    return ((a > b) + 0.5 * (a == b)).mean()


@pytest.mark.parametrize(("key", "label", "threshold"), [
    ("op2_toxicity", "toxic", 0.5), ("op9_quality", "quality", 0.3),
])
def test_held_out_accuracy(spark, key, label, threshold):
    rows = QUERIES[key](spark, LARGER).collect()
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert len(rows) == docs.count()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= threshold)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert area([r.score for r in tested], [truth[r.doc_id] for r in tested]) > 0.95
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) toxic",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality",
    )
    for module in (toxicity, quality):
        found = [
            {r.doc_id: r.score for r in module.score(docs, module.train(docs, given)).collect()}
            for given in (labels, turned)
        ]
        assert found[0].keys() == found[1].keys()
        assert all(abs(found[0][k] - found[1][k]) < 1e-9 for k in found[0])


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, module):
    rows = [(1, "fine words here", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "a", "x"),
            (4, "word " * 60_000, "x"), (5, "z" * 200_000, "x"), (6, " \n\t ", "x"), (7, "é\x00日", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    for given in ([], [(1, 1, 1)], [(1, 1, 1), (1, 0, 0), (2, 0, 0), (7, None, None), (None, 1, 1)]):
        labels = spark.createDataFrame(given, "doc_id bigint, toxic int, quality int")
        found = module.score(docs, module.train(docs, labels)).collect()
        assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 for r in found)
    empty = docs.limit(0)
    assert module.score(empty, module.train(empty, labels.limit(0))).count() == 0
    assert empty.select(held_out()).count() == 0


def test_words_equal_a_plain_split():
    chance = random.Random(2)
    texts = ["".join(chance.choices("aB c\n\x1cé\t", k=chance.randint(0, 30))) for _ in range(200)]
    texts += ["", " ", None]
    words = words_of(pa.array(texts))
    cut = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    plain = [(i, w) for i, t in enumerate(texts)
             for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    assert list(zip(words.rows.tolist(), cut, strict=True)) == plain
    by_word = {}
    for word, value in zip(cut, words.hashes().tolist(), strict=True):
        lowered = "".join(c.lower() if c.isascii() else c for c in word)
        assert by_word.setdefault(lowered, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_repeated_negative_risk_climbs_back():
    # the prior is stated far above the truth, so the clean risk's estimate turns negative
    chance = np.random.default_rng(0)
    p = np.arange(50), np.zeros(50, int), 50
    u = np.arange(100), (chance.random(100) < 0.9).astype(int), 100
    weights, bias = toxicity.fit_weights(p, u, 2, 0.8)
    assert np.isfinite(weights).all() and weights[0] > weights[1]


def test_log_density_difference_equals_the_formula():
    chance = np.random.default_rng(1)
    low, high = chance.normal(size=(80, 3)), chance.normal(1, 2, size=(120, 3))
    moments = [quality.Moments(len(x), x.sum(0), x.T @ x) for x in (low, high)]
    model = quality.discriminant(*moments, 0.0, 0.0)
    point = chance.normal(size=(5, 3))
    logs = []
    for x, prior in ((low, 0.4), (high, 0.6)):
        cov = np.cov(x.T, bias=True) + 1e-6 * np.eye(3)
        d = point - x.mean(0)
        logs.append(np.log(prior) - 0.5 * np.log(np.linalg.det(cov))
                    - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.scores(point), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_quality_training_shuffles_vectors_to_few_labels(spark, monkeypatch):
    # two steps in one stage would hold two workers for each task
    docs = materialise(spark.createDataFrame(
        [(i, f"word {i}") for i in (*range(40), 7)] + [(None, "word")], "doc_id bigint, text string"
    ))
    labels = materialise(spark.createDataFrame(
        [(i, i % 2) for i in range(40)], "doc_id bigint, quality int"
    ))
    plans, kind = [], type(docs)
    collect = kind.collect

    def collected(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(kind, "collect", collected)
    model = quality.train(docs, labels)
    _, between, _ = plans[-1].split("MapInArrow")
    assert "Exchange hashpartitioning" in between and "BroadcastExchange" not in plans[-1]
    learned = [i for i in (*range(40), 7) if zlib.crc32(str(i).encode()) % 5]
    vectors = quality.statistics(pa.array([f"word {i}" for i in learned]))
    odd = np.array(learned) % 2 == 1
    plain = quality.discriminant(*(
        quality.Moments(len(x), x.sum(0), x.T @ x) for x in (vectors[~odd], vectors[odd])
    ))
    assert np.allclose(model.scores(vectors), plain.scores(vectors))
