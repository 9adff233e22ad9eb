"""Packing documents into fixed windows, best fit decreasing.

A task turns its documents into token identifiers, cuts documents longer than a window
into full windows, and places the remainders: a bounded buffer of them is sorted by
falling length, and each goes to the open window with the least room that still holds
it. A segment tree over the remaining capacities finds that window. Windows stay open
for the task's later buffers, nothing is shuffled, and what a task holds is one buffer
and one number per window with room left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from kindred.llm import stores, wordpieces
from kindred.llm.slices import slices, texts_of, with_small_batches

#: Remainders and bytes of identifiers that a buffer holds at most (one longer document aside).
BUFFER_ROWS, BUFFER_BYTES = 8_192, 8_000_000
#: Parts and words kept per worker process; it bounds memory and changes no result.
CACHE_ENTRIES = 150_000
#: Characters of the longest part that is kept.
LONGEST_KEPT = 64
#: Stands between parts while they are encoded; no identifier.
_NO_ID = 0xFFFFFFFF
_BREAK = _NO_ID.to_bytes(4, "little")
#: Text parts that one call of the tokenizer gets.
PARTS_AT_ONCE = 20_000


class OpenWindows:
    """Windows with room left, found by the least capacity that suffices.

    The segment tree's leaf ``c`` counts the open windows with ``c`` tokens left.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, window: int, room: int) -> None:
        if room:
            self.windows[room].append(window)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The fullest window with at least ``need`` tokens left, and its room; it is removed."""
        node = need + self.leaves
        if not self.count[node]:
            # climb until a right sibling holds a window, then go down to its smallest leaf
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.windows[room].pop(), room

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node >>= 1


class Encoder:
    """Packed identifiers of texts, by the tokenizers library.

    White space never belongs to a token: a text falls into parts between white space
    and a part into words. The library encodes each new word once, many in a call; texts
    with special strings go to the library whole.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.vocabulary = wordpieces.load(path)
        self.model = Tokenizer(self.whole.model)  # merges alone, for words already split
        symbols = wordpieces.byte_symbols()
        self.symbols = {byte: symbols[byte] for byte in range(256) if byte != 10}
        self.pieces = regex.compile(self.vocabulary.pattern.pattern + r"|\n", self.vocabulary.pattern.flags)
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, number in self.whole.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        # words and parts alike: a word standing alone is a part with the same identifiers
        self.known: dict[str, bytes] = {"\n": _BREAK}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [text.split() if wordpieces.simple(text) else None for text in texts]
        if len(self.known) >= CACHE_ENTRIES:
            self.older, self.known = self.known, {"\n": _BREAK}
        missing = self._missing(set().union(*(parts for parts in split if parts)))
        for start in range(0, len(missing), PARTS_AT_ONCE):
            self._learn(missing[start : start + PARTS_AT_ONCE])
        known = self.known
        result = [
            self._whole(text) if parts is None else b"".join(map(known.__getitem__, parts))
            for text, parts in zip(texts, split, strict=True)
        ]
        for part in missing:
            if len(part) > LONGEST_KEPT:
                known.pop(part, None)
        return result

    def _missing(self, wanted: set[str]) -> list[str]:
        """Those of ``wanted`` that neither store knows; the older one's entries move over."""
        wanted, older = wanted.difference(self.known), self.older
        met = [part for part in wanted if part in older]
        self.known.update(zip(met, map(older.__getitem__, met), strict=True))
        return list(wanted.difference(met))

    def _whole(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, parts: list[str]) -> None:
        """Add ``parts`` to the known ones; one pass over all of them for every step."""
        plain = {part for part in parts if part.isalpha() and part.isascii() and part.islower()}
        others = [part for part in parts if part not in plain]
        pieces = self.pieces.findall(self.vocabulary.normalised("\n".join(others)))
        new = [*plain, *self._missing(set(pieces).difference(plain))]
        known = self.known
        if new:
            # line feeds stand in no word and have no symbol, so they keep the words apart
            symbols = "\n".join(new).encode("utf-8").decode("latin-1").translate(self.symbols)
            found = self.model.encode_batch_fast(
                [symbols.split("\n")], is_pretokenized=True, add_special_tokens=False
            )
            ids = np.array(found[0].ids, "<u4")
            packed = ids.tobytes()
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            values = [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            known.update(zip(new, values, strict=True))
        if others:
            packed = b"".join(map(known.__getitem__, pieces))
            breaks = 4 * np.flatnonzero(np.frombuffer(packed, "<u4") == _NO_ID)
            starts, ends = [0, *(breaks + 4).tolist()], [*breaks.tolist(), len(packed)]
            values = [packed[a:b] for a, b in zip(starts, ends, strict=True)]
            known.update(zip(others, values, strict=True))


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return stores.resident(Encoder, path)


def id_lists(packed: list[bytes]) -> pa.Array:
    """Packed identifiers as lists of integers."""
    edges = np.cumsum([0, *(len(value) // 4 for value in packed)], dtype=np.int32)
    values = np.frombuffer(b"".join(packed), "<i4")
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values, pa.int32()))


def pack(
    docs: DataFrame, window: int = 2048, end_id: int = 1, path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", lists: bool = False,
) -> DataFrame:
    """Pack every document, followed by ``end_id``, into windows of ``window`` tokens.

    Returns one row per piece: ``id, start, length, ids, doc_tokens, sequence_id, offset``.
    ``ids`` are the piece's identifiers, packed little-endian unsigned 32-bit (an array of
    integers with ``lists``); pieces of a
    document cover it from ``start`` 0 without gap; pieces of a sequence cover it from
    ``offset`` 0 without gap. A null or empty text is the end identifier alone. Repeated
    rows are packed each, other columns are ignored, an empty table gives no piece. Equal
    lengths keep their order in the table. Sequence ids are unique over all tasks and
    have gaps between tasks.
    """
    path = path or wordpieces.default_path()
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        windows = OpenWindows(window)
        rows: list[tuple] = []  # id, start, ids, tokens of the document
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_id, rows, held
            order = sorted(range(len(rows)), key=lambda at: -len(rows[at][2]))
            sequences, offsets = [0] * len(rows), [0] * len(rows)
            for at in order:
                length = len(rows[at][2]) // 4
                found = windows.take(length)
                if found is None:
                    found = next_id, window
                    next_id += 1
                sequences[at], offsets[at] = found[0], window - found[1]
                windows.put(found[0], found[1] - length)
            batch = pa.record_batch({
                id_col: pa.array([row[0] for row in rows], id_type),
                "start": pa.array([row[1] for row in rows], pa.int64()),
                "length": pa.array([len(row[2]) // 4 for row in rows], pa.int64()),
                "ids": id_lists([row[2] for row in rows]) if lists
                else pa.array([row[2] for row in rows], pa.binary()),
                "doc_tokens": pa.array([row[3] for row in rows], pa.int64()),
                "sequence_id": pa.array(sequences, pa.int64()),
                "offset": pa.array(offsets, pa.int64()),
            })
            rows, held = [], 0
            return batch

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in slices(batch, text_col):
                encoded = encoder(path).encode(texts_of(part.column(1)))
                for doc, ids in zip(part.column(0).to_pylist(), encoded, strict=True):
                    ids += end
                    tokens = len(ids) // 4
                    for start in range(0, tokens, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((doc, start, piece, tokens))
                        held += len(piece)
                        if len(rows) >= BUFFER_ROWS or held >= BUFFER_BYTES:
                            yield flush()
        if rows:
            yield flush()
        stores.trim()

    return with_small_batches(docs.select(id_col, text_col)).mapInArrow(
        task,
        f"`{id_col}` {kind}, start bigint, length bigint, ids {'array<int>' if lists else 'binary'},"
        " doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )
