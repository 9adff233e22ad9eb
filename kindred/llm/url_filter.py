"""URL verdicts by a bit-parallel automaton over many glob rules.

All patterns are laid side by side in a row of 64-bit words: one bit for a pattern's
start and one per character. For every byte of a URL the row is shifted by one, masked
with the places where that byte may stand, and joined with the places that a wildcard
lets stay. All URLs of a slice advance together, so one step serves every pattern and
every URL. ``?`` is one byte other than ``/``, ``*`` any run without ``/`` and ``**``
any run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm.slices import map_slices

ALLOW, BLOCK = "allow", "block"

#: Verdict of URLs that no host rule fits: blocked if one of these fits, else allowed.
DEFAULT_GLOBS = ("ads.**", "**/cgi-bin/**", "**/wp-login.php**")


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{_literal(self.name)}**", f"*.{_literal(self.name)}**"


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def _items(glob: str) -> list[tuple[str, int]]:
    """``(kind, byte)`` for every unit of a glob; kinds: byte, one, run, any."""
    data, items, at = glob.encode("utf-8"), [], 0
    while at < len(data):
        if data[at] == 0x5C and at + 1 < len(data):
            items.append(("byte", data[at + 1]))
            at += 2
        elif data[at : at + 2] == b"**":
            items.append(("any", 0))
            at += 2
        elif data[at] == 0x2A:
            items.append(("run", 0))
            at += 1
        elif data[at] == 0x3F:
            items.append(("one", 0))
            at += 1
        else:
            items.append(("byte", data[at]))
            at += 1
    return items


class Automaton:
    """Shift-And masks of several globs, simulated at once."""

    def __init__(self, globs: Sequence[str]):
        parsed = [_items(glob) for glob in globs]
        bits = sum(1 + sum(kind in ("byte", "one") for kind, _ in items) for items in parsed)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((256, self.words), np.uint64)  # bytes that lead to a place
        self.stay = np.zeros((256, self.words), np.uint64)  # bytes that a wildcard swallows there
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        every = np.arange(256)
        no_slash = every[every != 0x2F]
        at = -1
        for items in parsed:
            at += 1
            self._set(self.start, at)
            for kind, byte in items:
                if kind in ("byte", "one"):
                    at += 1
                    for value in [byte] if kind == "byte" else no_slash:
                        self._set(self.step[value], at)
                else:
                    for value in every if kind == "any" else no_slash:
                        self._set(self.stay[value], at)
            self.final.append((at // 64, np.uint64(1 << at % 64)))

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Whether each text (row) is matched whole by each glob (column)."""
        lengths = np.array([len(text) for text in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        falling = -lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        for place in range(int(-falling[0]) if len(texts) else 0):
            active = int(np.searchsorted(falling, -place, side="left"))  # longer than place
            byte, now = data[begin[:active] + place], state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.empty((len(texts), len(self.final)), bool)
        for column, (word, bit) in enumerate(self.final):
            found[order, column] = (state[:, word] & bit) != 0
        return found


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and for text without ``://``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    before = rest.partition("#")[0].partition("?")[0]
    host, slash, path = before.partition("/")
    lowered = host.encode("utf-8").lower().decode("utf-8")
    return lowered, slash + path


def judge_urls(
    pages: DataFrame, rules: Sequence[HostRule], globs: Sequence[str] = DEFAULT_GLOBS,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Verdict of every URL as ``id, host, path, rule, verdict``, one row per row of ``pages``.

    The longest host rule that fits decides; without one a URL is blocked if one of
    ``globs`` fits its host and path, else allowed (so are null and malformed URLs).
    Of rules with the same name the first counts. Repeated rows stay, other columns
    are ignored, an empty table gives an empty result. Nothing is shuffled.
    """
    by_length = sorted(rules, key=lambda rule: -len(rule.name))
    automaton = Automaton([glob for rule in by_length for glob in rule.globs()] + list(globs))
    names = np.array([*(rule.name for rule in by_length), None], object)
    verdicts = np.array([*(rule.verdict for rule in by_length), ALLOW], object)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        split = [host_and_path(url) for url in part.column(1).to_pylist()]
        found = automaton.matches([(host + path).encode("utf-8") for host, path in split])
        fits = np.ones((len(split), len(by_length) + 1), bool)
        fits[:, :-1] = found[:, 0 : 2 * len(by_length) : 2] | found[:, 1 : 2 * len(by_length) : 2]
        first = fits.argmax(axis=1)
        verdict = verdicts[first]
        blocked = found[:, 2 * len(by_length) :].any(axis=1)
        verdict[(first == len(by_length)) & blocked] = BLOCK
        return pa.record_batch({
            id_col: part.column(0),
            "host": pa.array([host for host, _ in split], pa.string()),
            "path": pa.array([path for _, path in split], pa.string()),
            "rule": pa.array(names[first].tolist(), pa.string()),
            "verdict": pa.array(verdict.tolist(), pa.string()),
        })

    kind = pages.schema[id_col].dataType.simpleString()
    return map_slices(
        pages.select(id_col, url_col), url_col, run,
        f"`{id_col}` {kind}, host string, path string, rule string, verdict string",
    )
