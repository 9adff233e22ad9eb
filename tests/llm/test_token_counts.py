import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import wordpieces
from kindred.llm.token_counts import Counter, token_counts

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ALPHABET = [
    *"aAbBİΣσςéÉß \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85  !'?.,0123½²٣ⅷ日本😀́̀ǅſK\x00",
    "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "<|", "the", "hello",
]


def expected(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


def test_count_equals_the_library_on_odd_texts():
    counter, chance = Counter(wordpieces.default_path()), random.Random(7)
    for _ in range(3000):
        text = "".join(chance.choice(ALPHABET) for _ in range(chance.randint(0, 16)))
        assert counter.count(text) == expected(text), repr(text)


@pytest.mark.parametrize("text", ["x" * 30_000, "ab" * 20_000, "word " * 50_000, "é" * 5_001])
def test_long_texts(text):
    assert Counter(wordpieces.default_path()).count(text) == expected(text)


def test_rows_nulls_repeats_and_other_columns(spark):
    rows = [(1, "Hello, world", "a"), (1, "Hello, world", "b"), (2, None, None), (3, "", "c"),
            (None, "x", "d"), (4, "wörd " * 3000, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    found = sorted(map(tuple, token_counts(docs).collect()), key=repr)
    wanted = [(i, len((t or "").encode()), expected(t), expected(t) > 2048) for i, t, _ in rows]
    assert found == sorted(wanted, key=repr)
    empty = token_counts(docs.limit(0))
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and empty.count() == 0
