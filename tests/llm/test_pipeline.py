import numpy as np
import pytest

import corpus_pipeline
from kindred.llm import pii, quality, toxicity
from kindred.llm.packing import Encoder, wordpieces
from tests_llm_helpers import brute_force

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and after the last."""
    found = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, found[-1], FOLDER).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:-1])
    assert [df.schema for df in stages[1:-1]] == [stages[0].schema] * 4


def test_classifiers_reject_what_they_score(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for before, after, module, rejected in (
        (stages[0], stages[1], toxicity, 1), (stages[1], stages[2], quality, 0),
    ):
        scored = module.score(before, module.train(before, labels)).collect()
        kept = rows(after)
        assert kept.keys() == {r.doc_id for r in scored if r.predicted != rejected}
        assert 0.5 * len(scored) < len(kept) < len(scored)
        given = rows(before)
        assert all(kept[i] == given[i] for i in kept)


def test_one_of_each_group_stays(stages):
    given, kept = rows(stages[2]), rows(stages[3])
    wanted = {i for i, (_, c) in brute_force({i: r.text for i, r in given.items()}).items() if i == c}
    assert kept.keys() == wanted and len(kept) == stages[3].count()
    assert all(kept[i] == given[i] for i in kept)


def test_personal_data_is_gone(stages):
    given, kept = rows(stages[3]), rows(stages[4])
    assert kept.keys() == given.keys()
    for i, row in kept.items():
        assert row.n_chars == len(row.text) and not pii.base_spans(row.text)
        if not pii.base_spans(given[i].text) and not pii.candidates(given[i].text, []):
            assert row == given[i]


def test_pieces_hold_every_document(stages):
    encoder, texts = Encoder(wordpieces.default_path()), rows(stages[4])
    pieces = {}
    for row in stages[5].collect():
        pieces.setdefault(row.doc_id, []).append((row.start, row.ids))
    assert pieces.keys() == texts.keys()
    for i, parts in pieces.items():
        ids = [number for _, part in sorted(parts) for number in part]
        assert ids == [*np.frombuffer(encoder.encode([texts[i].text])[0], "<u4").tolist(), 1]


def test_run_equals_the_stages(spark, stages):
    order = ["doc_id", "start", "length", "doc_tokens"]
    found = corpus_pipeline.run(spark, FOLDER)
    assert sorted(found.select(*order).collect()) == sorted(stages[5].select(*order).collect())


def test_odd_documents(spark):
    base = "plain words that say nothing bad about anybody here at all in this long line of text"
    given = [(1, base), (1, base), (2, base), (3, None), (4, ""), (4, ""), (None, base), (None, "x y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in given],
                                 spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    kept = corpus_pipeline.without_copies(spark, docs, FOLDER).collect()
    # rows without id cannot be told apart: all stay if one of them does
    assert sorted(repr(r.doc_id) for r in kept) == sorted(map(repr, [1, 3, 4, 4, None, None]))
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, FOLDER).collect()
