import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import packing
from kindred.llm.packing import Encoder, OpenWindows, pack
from kindred.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, texts, window):
    """Each document is covered once, each window without gap; returns the windows' lengths."""
    by_doc, by_window = {}, {}
    for row in pieces:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_window.setdefault(row.sequence_id, []).append(row)
    assert set(by_doc) == set(texts)
    for doc, rows in by_doc.items():
        rows.sort(key=lambda row: row.start)
        ids = ids_of(texts[doc])
        at = 0
        for row in rows:
            assert row.start == at and row.doc_tokens == len(ids)
            wanted = np.array(ids[at : at + row.length], "<u4").tobytes()
            if "ids" in row:
                assert bytes(row.ids) == wanted
            else:
                assert row.ids_crc32 == zlib.crc32(wanted)
            at += row.length
        assert at == len(ids)
    lengths = []
    for rows in by_window.values():
        rows.sort(key=lambda row: row.offset)
        at = 0
        for row in rows:
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= window
        lengths.append(at)
    return lengths


def test_tree_finds_the_tightest_window():
    chance, tree, plain = random.Random(5), OpenWindows(50), {}
    for step in range(3000):
        if chance.random() < 0.5:
            room = chance.randint(0, 50)
            tree.put(step, room)
            if room:
                plain[step] = room
        else:
            need = chance.randint(1, 50)
            found = tree.take(need)
            fits = [room for room in plain.values() if room >= need]
            assert (found is None) == (not fits)
            if found:
                assert found[1] == min(fits) == plain.pop(found[0])


@pytest.mark.parametrize("window", [16, 2048])
def test_pieces(spark, monkeypatch, window):
    chance = random.Random(1)
    texts = {i: " ".join(chance.choices(["a", "Bee", "sea!", "deé"], k=chance.randint(0, 200)))
             for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: "long words " * 9000, 1003: "x <|endoftext|>y\x1cz"}
    docs = spark.createDataFrame(
        [(i, t, "other") for i, t in texts.items()], "doc_id bigint, text string, ids string"
    ).coalesce(2)
    lengths = check(pack(docs, window).collect(), texts, window)
    total = sum(len(ids_of(text)) for text in texts.values())
    assert len(lengths) <= total / window + (4 if window == 2048 else 0.05 * total / window)


def test_repeats_null_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.length for r in pack(docs).collect()) == [2, 3, 3]
    assert pack(docs.limit(0)).count() == 0


def test_parts_equal_whole_texts():
    chance, encoder = random.Random(2), Encoder(packing.wordpieces.default_path())
    alphabet = [*"aAB \n\x1c\x85 Σσİé!'0½日", "<|endoftext|>", "'LL"]
    texts = ["".join(chance.choices(alphabet, k=chance.randint(0, 20))) for _ in range(2000)]
    wanted = [np.array(ids_of(text)[:-1], "<u4").tobytes() for text in texts]
    assert encoder.encode(texts) == wanted
    assert encoder.encode(["a! b", "b a!"])[1] == np.array(ids_of("b a!")[:-1], "<u4").tobytes()
    # a new part of words that are known already
    assert encoder.encode(["ba!"])[0] and encoder.encode(["ba! !"])[0] and encoder.encode(["!ba"])[0]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check(QUERIES["op3_packing"](spark, folder).collect(), texts, 2048)
