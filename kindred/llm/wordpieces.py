"""Words of the word-end BPE vocabulary: normalising and splitting as its JSON file states."""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import regex

#: Special strings start like this; on the others ``str.split`` and the tokenizer may not agree.
_NOT_SIMPLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "\x85")


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte, in byte order.

    Printable Latin-1 bytes stand for themselves, the others take the code points
    from 256 upwards in turn.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(spare)) for byte in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What the vocabulary file says, in the form that merging needs."""

    pattern: regex.Pattern
    special: regex.Pattern
    inner: list[int]
    last: list[int]
    ranks: dict[int, int]
    result: list[int]
    width: int

    def words(self, text: str) -> list[str]:
        """The pieces of a text without special strings."""
        return self.pattern.findall(self.normalised(text))

    def normalised(self, text: str) -> str:
        """Composed and in lower case."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    end = content["model"]["end_of_word_suffix"]
    width = max(vocabulary.values()) + 1
    merges = content["model"]["merges"]
    ranks = {
        vocabulary[left] * width + vocabulary[right]: rank
        for rank, (left, right) in enumerate(merges)
    }
    symbols = byte_symbols()
    split = next(
        part["pattern"]["Regex"] for part in content["pre_tokenizer"]["pretokenizers"]
        if part["type"] == "Split"
    )
    special = "|".join(
        regex.escape(token["content"])
        for token in sorted(content["added_tokens"], key=lambda token: -len(token["content"]))
    )
    return Vocabulary(
        regex.compile(split), regex.compile(special),
        [vocabulary[symbol] for symbol in symbols], [vocabulary[symbol + end] for symbol in symbols],
        ranks, [vocabulary[left + right] for left, right in merges], width,
    )


def simple(text: str) -> bool:
    """Whether white space alone cuts ``text`` into parts that may be treated one by one."""
    return not any(odd in text for odd in _NOT_SIMPLE)
