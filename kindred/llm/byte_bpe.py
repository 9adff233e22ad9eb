"""Byte-level BPE in DuckDB: recursive contraction to encode, ordered aggregation to decode.

Every Spark partition works for itself. The words of a slice of texts that are not yet
known become token-position rows ``(word, place, next place, token)``. A recursive query
joins neighbouring rows with the merge table and contracts, in every word, the leftmost
pair of the lowest rank; a word without such a pair has reached its fixpoint and leaves
the recursion. Decoding joins token rows with the vocabulary and aggregates their bytes
in order.
"""

from __future__ import annotations

import base64

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kindred.llm.slices import map_slices, texts_of
from kindred.llm.stores import resident

#: Words kept per worker process and generation; it bounds memory and changes no result.
CACHE_ENTRIES = 160_000
#: Characters of the longest word that is kept.
LONGEST_KEPT = 64
#: Bytes of text, or of identifiers, that are worked on at a time.
ENCODE_BYTES, DECODE_BYTES = 2_000_000, 2_000_000
#: Words of a recursive query.
WORDS_AT_ONCE = 25_000

#: Symbols of a recursive query, longer words aside; it bounds the rows of a state.
SYMBOLS_AT_ONCE = 250_000
#: Rounds of a query, so states that are held: short words are done soon, and their rows go.
ROUNDS_SHORT, ROUNDS_LONG = 24, 8
#: Bytes that DuckDB may use, and those that it may use besides for each symbol of a query.
MEMORY, MEMORY_A_SYMBOL = 250_000_000, 1_000

# A pair's score is its rank (17 bits), its place (34 bits) and the length of its left token
# (12 bits): the smallest score of a word names the pair to contract and the row that goes.
_ENCODE_SHORT = """
WITH RECURSIVE step(n, w, p, q, t) AS (
    SELECT 0, w, p, q, t FROM symbols
    UNION ALL
    (
        WITH scored AS MATERIALIZED (
            SELECT a.w, b.q AS q2, m.rank,
                   m.rank * (1::BIGINT << 46) + a.p * 4096 + (a.q - a.p) AS score
            FROM step a JOIN step b ON a.q = b.p
            JOIN merges m ON m.pair = a.t * width() + b.t
        ), best AS MATERIALIZED (
            SELECT w, (min(score) >> 12) & ((1::BIGINT << 34) - 1) AS spot,
                   spot + (min(score) & 4095) AS gone,
                   arg_min(q2, score) AS q2, arg_min(rank, score) AS rank
            FROM scored GROUP BY w
        )
        SELECT n + 1, w, p, if(p = spot, q2, q), if(p = spot, rank, t)
        FROM step JOIN best USING (w) WHERE n < {rounds} AND p <> gone
    )
)
SELECT w, p, q, t, n FROM step JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n)
ORDER BY p
"""

# ``many`` ranks cannot give rise to a pair of the same or a lower rank, so what follows the
# leftmost pair is to contract it again further right: a round contracts all of them, every
# second one where they overlap. Of other ranks a round contracts the leftmost pair alone.
_ENCODE_LONG = """
WITH RECURSIVE step(n, w, p, q, t) AS (
    SELECT 0, w, p, q, t FROM symbols
    UNION ALL
    (
        WITH scored AS MATERIALIZED (
            SELECT a.w, a.p, a.q, b.q AS q2, m.rank, m.many
            FROM step a JOIN step b ON a.q = b.p
            JOIN merges m ON m.pair = a.t * width() + b.t
        ), best AS MATERIALIZED (
            SELECT w, min(rank) AS rank FROM scored GROUP BY w
        ), lowest AS MATERIALIZED (
            SELECT *, row_number() OVER spot AS place, lag(q) OVER spot IS DISTINCT FROM p AS alone
            FROM scored SEMI JOIN best USING (w, rank)
            WINDOW spot AS (PARTITION BY w ORDER BY p)
        ), chosen AS MATERIALIZED (
            SELECT p, q, q2, rank FROM (
                SELECT *, place - max(if(alone, place, 0)) OVER (PARTITION BY w ORDER BY p) AS behind
                FROM lowest
            ) WHERE if(many, behind % 2 = 0, place = 1)
        )
        SELECT n + 1, s.w, s.p, coalesce(c.q2, s.q), coalesce(c.rank, s.t)
        FROM step s SEMI JOIN best USING (w) LEFT JOIN chosen c ON s.p = c.p
        WHERE n < {rounds} AND s.p NOT IN (SELECT q FROM chosen)
    )
)
SELECT w, p, q, t, n FROM step JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n)
ORDER BY p
"""

_DECODE = """
SELECT d, string_agg(coalesce(c, error('identifier outside the vocabulary')), '' ORDER BY i) AS c
FROM ids LEFT JOIN vocabulary USING (id) GROUP BY d
"""


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, which is also the identifier."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """The vocabulary as DuckDB tables, and the words met lately."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        width = max(ranks.values()) + 1
        pairs = [
            (left, right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None
            and (right := ranks.get(token[cut:])) is not None
        ]
        # one thread: Spark runs a worker per core; memory is bounded by the slices
        self.database = duckdb.connect(
            ":memory:",
            config={"threads": 1, "temp_directory": "", "memory_limit": f"{MEMORY // 10**6}MB"},
        )
        self.database.execute(f"CREATE MACRO width() AS {width}::BIGINT")
        left, right, rank = np.array(pairs, np.int64).T
        lowest = np.full(width, width)  # rank of a pair that a token can be part of
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        merges = {"pair": left * width + right, "rank": rank, "many": lowest[rank] > rank}
        self._create("merges", pa.table(merges))
        # DuckDB aggregates text: every byte as the character of its code point
        tokens = [(rank, token.decode("latin-1")) for token, rank in ranks.items()]
        self._create(
            "vocabulary", pa.table({"id": [i for i, _ in tokens], "c": [c for _, c in tokens]})
        )

    def _create(self, name: str, content: pa.Table) -> None:
        self.database.register("given", content)
        self.database.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.database.unregister("given")

    def _query(self, name: str, content: pa.Table, sql: str) -> dict[str, np.ndarray]:
        self.database.register(name, content)
        try:
            return self.database.execute(sql).fetchnumpy()
        finally:
            self.database.unregister(name)

    def contract(self, words: list[str]) -> list[bytes]:
        """The identifiers of each word, as little-endian unsigned 32-bit integers."""
        encoded = [word.encode("utf-8") for word in words]
        sizes = np.array([len(word) for word in encoded], np.int64)
        place = np.arange(sizes.sum())
        following = place + 1
        following[np.cumsum(sizes) - 1] = -1
        state = {
            "w": np.repeat(np.arange(len(words)), sizes), "p": place, "q": following,
            "t": self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)],
        }
        result = [b""] * len(words)
        self.database.execute(
            f"SET memory_limit = '{(MEMORY + MEMORY_A_SYMBOL * len(place)) // 10**6}MB'"
        )
        # a tie of pairs is rare in short words, and looking for one takes time
        long = sizes.max(initial=0) > LONGEST_KEPT
        sql, most = (_ENCODE_LONG, ROUNDS_LONG) if long else (_ENCODE_SHORT, ROUNDS_SHORT)
        while len(state["w"]):
            # long words have few rounds a query, so that its rows stay in proportion to them
            rounds = max(1, min(most, most * SYMBOLS_AT_ONCE // len(state["w"])))
            state = self._query("symbols", pa.table(state), sql.format(rounds=rounds))
            open_words = state.pop("n") == rounds
            done = ~open_words
            ids = state["t"][done].astype("<u4").tobytes()
            starts = np.flatnonzero(np.diff(state["w"][done], prepend=-1))
            ends = (4 * np.append(starts[1:], done.sum())).tolist() if len(starts) else []
            for word, a, b in zip(
                state["w"][done][starts].tolist(), (4 * starts).tolist(), ends, strict=True
            ):
                result[word] = ids[a:b]
            state = {name: column[open_words] for name, column in state.items()}
        return result

    def encode(self, texts: list[str]) -> list[bytes]:
        """The identifiers of every text."""
        split = [self.pattern.findall(text) for text in texts]
        if len(self.known) >= CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = []
        for word in set().union(*split).difference(known):
            value = older.get(word)
            if value is None:
                missing.append(word)
            else:
                known[word] = value
        missing.sort(key=len)  # words of a query then take about as many rounds
        start, symbols = 0, 0
        for at, word in enumerate(missing):
            size = len(word.encode("utf-8"))
            if at > start and (symbols + size > SYMBOLS_AT_ONCE or at - start == WORDS_AT_ONCE):
                part = missing[start:at]
                known.update(zip(part, self.contract(part), strict=True))
                start, symbols = at, 0
            symbols += size
        part = missing[start:]
        known.update(zip(part, self.contract(part) if part else [], strict=True))
        result = [b"".join(map(known.__getitem__, words)) for words in split]
        for word in missing:
            if len(word) > LONGEST_KEPT:
                del known[word]
        return result

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """The bytes that lists of identifiers stand for."""
        sizes = np.array([len(ids) // 4 for ids in texts], np.int64)
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        result = [b""] * len(texts)
        if len(ids):
            rows = pa.table({
                "d": np.repeat(np.arange(len(texts)), sizes), "i": np.arange(len(ids)), "id": ids,
            })
            found = self._query("ids", rows, _DECODE)
            for at, text in zip(found["d"].tolist(), found["c"].tolist(), strict=True):
                result[at] = text.encode("latin-1")
        return result


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return resident(Codec, path, pattern)


def encode_texts(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Identifiers of every text as ``id, ids``; ids are packed little-endian unsigned 32-bit.

    One row per row of ``docs``: repeated rows stay, a null or empty text has empty ids,
    other columns are ignored, an empty table gives an empty result. Special strings are
    ordinary text. Nothing is shuffled.
    """
    path = path or default_path()

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec(path, pattern).encode(texts_of(part.column(1)))
        return pa.record_batch({id_col: part.column(0), "ids": pa.array(ids, pa.binary())})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(id_col, text_col), text_col, run, f"`{id_col}` {kind}, ids binary", ENCODE_BYTES, True,
    )


def decode_ids(
    encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id", ids_col: str = "ids",
) -> DataFrame:
    """The packed identifiers with their decoded bytes, as ``id, ids, decoded``.

    Null or empty ids decode to no bytes. An identifier outside the vocabulary is an error.
    """
    path = path or default_path()

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        given = [value or b"" for value in part.column(1).to_pylist()]
        decoded = codec(path, pattern).decode(given)
        return pa.record_batch({
            id_col: part.column(0), "ids": pa.array(given, pa.binary()),
            "decoded": pa.array(decoded, pa.binary()),
        })

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_slices(
        encoded.select(id_col, ids_col), ids_col, run,
        f"`{id_col}` {kind}, ids binary, decoded binary", DECODE_BYTES, True,
    )
