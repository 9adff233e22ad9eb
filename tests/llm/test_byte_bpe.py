import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException

from kindred.llm.byte_bpe import Codec, decode_ids, default_path, encode_texts, read_ranks
from kindred.llm.queries import QUERIES

RANKS = read_ranks(default_path())
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
ALPHABET = [*"aAbeé \t\n\r  '!?.0123½日本😀́\x00", "'s", "<|endoftext|>", "the", " hello", "   "]


def packed(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


def test_round_trip_equals_the_library():
    codec, chance = Codec(default_path(), public_tokenizers.PATTERN), random.Random(3)
    texts = [
        "".join(chance.choice(ALPHABET) for _ in range(chance.randint(0, 30))) for _ in range(3000)
    ]
    texts += ["ab" * 1500, "word " * 30_000, "é" * 1000, ""]
    ids = codec.encode(texts)
    assert ids == [packed(text) for text in texts]
    assert codec.decode(ids) == [text.encode() for text in texts]


def test_long_words_need_no_memory_for_their_rounds(spark):
    chance = random.Random(8)

    def letters(count):
        return "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(count))

    texts = [
        letters(4000), "a" * 20_000, "".join(chr(chance.randint(0x4E00, 0x9FA5)) for _ in range(10_000)),
        " ".join(letters(60) for _ in range(8000)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for row in decode_ids(encode_texts(docs)).collect():
        assert bytes(row.ids) == packed(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode()


def test_overlapping_pairs_follow_the_leftmost_one():
    codec = Codec(default_path(), public_tokenizers.PATTERN)
    words = [letter * count for letter in "aeot-=_" for count in range(1, 40)]
    assert codec.contract(words) == [packed(word) for word in words]


def test_rows_nulls_repeats_and_other_columns(spark):
    rows = [(1, "Hello world", "a"), (1, "Hello world", "b"), (2, None, None), (3, "", "c"),
            (None, "x y", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = sorted(map(tuple, decode_ids(encode_texts(docs)).collect()), key=repr)
    assert found == sorted(
        ((i, bytearray(packed(t or "")), bytearray((t or "").encode())) for i, t, _ in rows), key=repr
    )
    assert decode_ids(encode_texts(docs.limit(0))).count() == 0


def test_unknown_identifier_is_an_error(spark):
    bad = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "doc_id bigint, ids binary")
    with pytest.raises(PythonException):
        decode_ids(bad).collect()


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op10_byte_bpe"](spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = packed(texts[row.doc_id])
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
