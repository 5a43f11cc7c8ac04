"""Texts as sequences of words or units, each different one looked at once.

A Python worker keeps what it has learned of each unit, told apart by a hash. Beyond a limit the half
met most often stays. Long texts are taken in pieces, cut at blanks, so that memory follows the
longest stretch without one, not the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

#: Characters of one piece of a text, and of the texts of one step, about.
PIECE = 1 << 20
#: Units that a worker keeps.
REMEMBERED = 120_000
#: A blank with other characters on both sides.
CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text cut at blanks that stand alone, which go; a text without any is one piece."""
    start = 0
    while len(text) - start > most:
        cut = CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def stretches(texts: list[str], most: int = PIECE) -> Iterator[tuple[list[str], list[bool]]]:
    """Pieces of the texts, about `most` characters at a time, and whether each ends its text."""
    held: list[str] = []
    ends: list[bool] = []
    size = 0
    for text in texts:
        for piece in [text] if len(text) <= most else pieces(text, most):
            held.append(piece)
            ends.append(False)
            size += len(piece)
            if size >= 2 * most and len(held) > 1:
                yield held[:-1], ends[:-1]
                held, ends, size = held[-1:], ends[-1:], len(piece)
        ends[-1] = True
        if size >= most:
            yield held, ends
            held, ends, size = [], [], 0
    if held:
        yield held, ends


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in the files of byte-level tokenizers: itself if it
    can be seen, else one of those from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Ragged:
    """Rows of numbers of different lengths, behind one another."""

    def __init__(self, kind):
        self.values, self.used = np.zeros(1 << 12, kind), 0
        self.first, self.count, self.rows = np.zeros(1 << 8, np.int64), np.zeros(1 << 8, np.int64), 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.rows + len(counts) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        new = slice(self.rows, self.rows + len(counts))
        self.first[new], self.count[new] = self.used + np.cumsum(counts) - counts, counts
        self.values[self.used : self.used + len(values)] = values
        self.used, self.rows = self.used + len(values), self.rows + len(counts)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows, behind one another, and how many each has."""
        count = self.count[rows]
        upto = np.cumsum(count)
        at = np.repeat((self.first[rows] - upto + count).astype(np.int32), count)
        at += np.arange(len(at), dtype=np.int32)
        return self.values[at], count

    def keep(self, rows: np.ndarray) -> None:
        values, count = self.take(rows)
        kept = Ragged(self.values.dtype)
        kept.add(values, count)
        self.__dict__.update(kept.__dict__)


class Known:
    """Rows of the units met, by hash. learn(places) adds rows to the tables for the units at
    these places of what is asked for, and keep(rows) leaves the tables with these rows."""

    def __init__(self, learn: Callable[[np.ndarray], None], keep: Callable[[np.ndarray], None], most: int | None = None):
        self.learn, self.keep, self.most = learn, keep, most or REMEMBERED
        # sorted by hash: the row of each, and how often it was met
        self.hashes = np.zeros(0, np.uint64)
        self.row, self.hits = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _missing(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        return at, np.flatnonzero(~known)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The rows of units with different, sorted hashes, good until the next call."""
        at, missing = self._missing(hashes)
        if len(missing):
            if len(self.hashes) + len(missing) > self.most:
                self._forget()
                at, missing = self._missing(hashes)
            n = len(self.hashes)
            for i in range(0, len(missing), 4096):
                self.learn(missing[i : i + 4096])
            self.row = np.insert(self.row, at[missing], np.arange(n, n + len(missing)))
            self.hits = np.insert(self.hits, at[missing], 0)
            self.hashes = np.insert(self.hashes, at[missing], hashes[missing])
            at = np.searchsorted(self.hashes, hashes)
        self.hits[at] += 1
        return self.row[at]

    def _forget(self) -> None:
        stays = np.sort(np.argsort(-self.hits, kind="stable")[: self.most // 2])
        self.hashes, self.hits = self.hashes[stays], self.hits[stays] // 2
        rows, self.row = np.unique(self.row[stays], return_inverse=True)
        self.keep(rows)
