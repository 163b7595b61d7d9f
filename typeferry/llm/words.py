"""Words of whole texts as 64-bit hashes, many texts at a time, in numpy.

A word is a run of letters and digits, compared in lower case. Its hash is a polynomial over
its bytes, from the difference of two running sums, so that the words of a buffer, and their
beginnings, are hashed without a loop.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from typeferry.llm.common import kept_by_worker

BASE = 0x9E3779B97F4A7C15
CHECK = 0xD1342543DE82EF95
BUFFER = 1 << 19  # characters hashed at once

# Punctuation and spaces beyond ASCII; all other bytes above it belong to letters.
_SEPARATORS = re.compile(
    "[\u0080-©«-´¶-¹»-¿×÷  -⁯"
    "⸀-⹿　-〿＀-／]+"
)
_WORD_BYTES = np.array([bytes([b]).isalnum() or b >= 0x80 for b in range(256)])


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
kept_by_worker(_tables.clear)


def _powers(size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64, ``size`` of them or more.

    The longest so far are kept; they double, so a worker has few sizes to go through.
    """
    found = _tables.get(base)
    if found is None or len(found[0]) < size:
        length = max(1 << 10, 1 << (size - 1).bit_length())
        tables = []
        for each in (base, pow(base, -1, 1 << 64)):
            steps = np.full(length, each, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        found = _tables[base] = tables[0], tables[1]
    return found


def span_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of each span of ``data``."""
    out = []
    for base in (BASE, CHECK):
        powers, inverse = _powers(len(data) + 1, base)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
        out.append((sums[ends] - sums[starts]) * inverse[starts])
    return out


def plain(text: str) -> bytes:
    text = text.lower()
    return (text if text.isascii() else _SEPARATORS.sub(" ", text)).encode()


@dataclass(frozen=True)
class Words:
    """Words of some texts in order: ``text`` numbers, and spans in a buffer of bytes."""

    sums: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``length`` bytes."""
        ends = self.ends if length is None else np.minimum(self.starts + length, self.ends)
        raw = self.sums[ends] - self.sums[self.starts]
        x = raw * _powers(self.sums.size)[1][self.starts]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _words(raw: bytes, edges: np.ndarray, numbers: np.ndarray) -> Words:
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], _WORD_BYTES[data], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[::2], change[1::2]
    powers = _powers(len(raw) + 1)[0]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)], out=sums[1:])
    text = numbers[np.searchsorted(edges, starts, side="right") - 1]
    return Words(sums, starts, ends, text)


def word_batches(texts: list[str | None]) -> Iterator[Words]:
    """The words of all texts, in order, a buffer at a time. A long text spans several."""
    parts: list[bytes] = []
    edges, numbers, size = [], [], 0

    def flush() -> Words:
        return _words(b"".join(parts), np.array(edges), np.array(numbers))

    for number, text in enumerate(texts):
        raw = plain(text or "")
        at = 0
        while at < len(raw):
            end = min(len(raw), at + BUFFER)
            if end < len(raw):  # cut between words, if there are any
                tail = np.flatnonzero(~_WORD_BYTES[np.frombuffer(raw[at:end], np.uint8)])
                end = at + int(tail[-1]) + 1 if len(tail) else _word_end(raw, end)
            if parts and size + end - at > BUFFER:
                yield flush()
                parts, edges, numbers, size = [], [], [], 0
            edges.append(size)
            numbers.append(number)
            parts.append(raw[at:end] + b"\n")
            size += end - at + 1
            at = end
    if parts:
        yield flush()


def _word_end(raw: bytes, at: int) -> int:
    while at < len(raw) and _WORD_BYTES[raw[at]]:
        at += 1
    return at


class Terms:
    """Numbers for a set of hashes, -1 for any other; ``sorted`` gives them back."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.sorted >> np.uint64(44)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.sorted):
            return out
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.sorted, hashes[some]), len(self.sorted) - 1)
        there = self.sorted[at] == hashes[some]
        out[some[there]] = at[there]
        return out
