"""Words of many texts at once, as numpy arrays over the texts' bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240229)
#: A random 64-bit value per byte; white space and other separators count 0 where they are dropped.
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of SplitMix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _place_weight(place: np.ndarray) -> np.ndarray:
    """An odd 64-bit weight per place in a word."""
    return mix(place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_WEIGHTS = _place_weight(np.arange(4096))


@dataclass(frozen=True)
class Words:
    """Words of a batch: byte range in ``data`` and row of the text that holds them."""

    data: np.ndarray
    text_starts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.starts

    def per_text(self) -> np.ndarray:
        """Number of words of each text."""
        return np.bincount(self.rows, minlength=len(self.text_starts) - 1)

    def hashes(self, first: int | None = None) -> np.ndarray:
        """64-bit hash of every word, or of its first bytes, A-Z lower-cased."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        sizes = self.sizes if first is None else np.minimum(self.sizes, first)
        begins = np.cumsum(sizes) - sizes
        # narrow numbers: these arrays have an entry per byte
        kind = np.int32 if len(self.data) < 2**31 else np.int64
        place = np.arange(int(sizes.sum()), dtype=kind) - np.repeat(begins.astype(kind), sizes)
        byte = LOWER[self.data[np.repeat(self.starts.astype(kind), sizes) + place]]
        if len(place) and int(place.max()) < len(_WEIGHTS):
            weight = _WEIGHTS[place]
        else:
            weight = _place_weight(place)
        values = _BYTE[byte]
        values *= weight
        return mix(np.add.reduceat(values, begins))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and where each starts (one more entry for the end)."""
    values = [value or b"" for value in column.cast(pa.binary()).to_pylist()]
    starts = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(value) for value in values], out=starts[1:])
    return np.frombuffer(b"".join(values), np.uint8), starts


def words_of(column: pa.Array, letters_only: bool = False) -> Words:
    """Runs of bytes other than the six white-space characters (or of letters and digits)."""
    data, text_starts = text_bytes(column)
    inside = _LETTER[data] if letters_only else ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = text_starts[:-1][text_starts[:-1] < len(data)]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = text_starts[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(text_starts, starts, side="right") - 1
    return Words(data, text_starts, starts, np.flatnonzero(ends) + 1, rows)
