"""Token counts by byte-pair merging on a heap and a linked list.

A word starts as one symbol per byte. The heap holds the adjacent pairs that the
vocabulary can merge, lowest rank and then leftmost first; a popped pair that still
stands is merged in the linked list and its two new neighbours enter the heap. The
count is the number of symbols at the start minus the merges made; no identifier
leaves the function.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm import wordpieces
from kindred.llm.slices import map_slices, texts_of

#: Counts kept per worker process; the store's older half is dropped when it is full.
CACHE_ENTRIES = 250_000
#: Characters of the longest word that is kept.
LONGEST_KEPT = 64


def merged_count(word: bytes, vocabulary: wordpieces.Vocabulary) -> int:
    """Tokens of one word: its bytes less the merges that the vocabulary makes."""
    size = len(word)
    if size < 2:
        return size
    rank_of, width, result = vocabulary.ranks.get, vocabulary.width, vocabulary.result
    inner = vocabulary.inner
    symbols = [inner[byte] for byte in word]
    symbols[-1] = vocabulary.last[word[-1]]
    # the rank of the pair that starts at each symbol, -1 if there is none
    ranks = [
        rank_of(left * width + right, -1)
        for left, right in zip(symbols, symbols[1:], strict=False)
    ]
    heap = [rank << 32 | at for at, rank in enumerate(ranks) if rank >= 0]
    if not heap:
        return size
    ranks.append(-1)
    heapq.heapify(heap)
    following = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    made = 0
    while heap:
        top = heapq.heappop(heap)
        rank, at = top >> 32, top & 0xFFFFFFFF
        if ranks[at] != rank:  # the pair has changed since it was pushed
            continue
        made += 1
        merged = symbols[at] = result[rank]
        gone = following[at]
        after = following[at] = following[gone]
        ranks[gone] = ranks[at] = -1
        if after < size:
            before[after] = at
            rank = rank_of(merged * width + symbols[after], -1)
            if rank >= 0:
                ranks[at] = rank
                heapq.heappush(heap, rank << 32 | at)
        ahead = before[at]
        if ahead >= 0:
            rank = ranks[ahead] = rank_of(symbols[ahead] * width + merged, -1)
            if rank >= 0:
                heapq.heappush(heap, rank << 32 | ahead)
    return size - made


class Recent(dict):
    """A bounded store of computed values: two generations, the older is dropped when the
    younger is full, and what is still in use moves over. It changes no result."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, key: str) -> int:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Counter:
    """Counts of texts; single words and white-space separated parts are kept as they are met."""

    def __init__(self, path: str):
        self.vocabulary = wordpieces.load(path)
        self.words = Recent(lambda word: merged_count(word.encode("utf-8"), self.vocabulary))
        self.parts = Recent(self._plain)

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings count as one token each."""
        if wordpieces.simple(text):
            return sum(map(self.parts.__getitem__, text.split()))
        total, start = 0, 0
        for match in self.vocabulary.special.finditer(text):
            total += self._plain(text[start : match.start()]) + 1
            start = match.end()
        return total + self._plain(text[start:])

    def _plain(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.vocabulary.words(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary."""
    return Counter(path)


def token_counts(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """Bytes and tokens of every text.

    Returns ``id, n_bytes, n_tokens, over_limit`` with one row per row of ``docs``:
    repeated rows stay repeated, a null or empty text counts 0, other columns are
    ignored, an empty table gives an empty result. Rows never leave their partition.
    """
    path = path or wordpieces.default_path()

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(path).count
        texts = texts_of(part.column(1))
        tokens = [count(text) for text in texts]
        return pa.record_batch({
            id_col: part.column(0),
            "n_bytes": pa.array([len(text.encode("utf-8")) for text in texts], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        })

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(id_col, text_col), text_col, run,
        f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
