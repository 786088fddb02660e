"""Words of Arrow string columns as numpy arrays: where they begin and end, and hashes of them and of their runs.

A word is a run of bytes other than space and 0x09 to 0x0D; no byte of a longer UTF-8 character is one of these, so
working on bytes and working on code points finds the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts worked on at a time; a longer text is a slice of its own

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a splitmix finish)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[_BLANK] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_STEP_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    raw = pa.types.is_binary(column.type)
    column = column.fill_null(b"" if raw else "").cast(pa.large_binary() if raw else pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in the same order, in batches of about ``most`` bytes of text."""
    for batch in batches:
        _, offsets = texts(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


@dataclass
class Words:
    """Words of several texts in order. ``first[i]`` is the first word of text i, ``first[-1]`` the number of words."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Words:
        data, offsets = texts(column)
        letter = ~_BLANK[data]
        before = np.zeros(len(data), bool)
        before[1:] = letter[:-1]
        inside = offsets[:-1][offsets[:-1] < len(data)]
        before[inside] = False
        after = np.zeros(len(data), bool)
        after[:-1] = letter[1:]
        after[inside[inside > 0] - 1] = False
        start = np.flatnonzero(letter & ~before)
        end = np.flatnonzero(letter & ~after) + 1
        return cls(data, offsets, start, end, np.searchsorted(start, offsets))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def count(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    def left(self) -> np.ndarray:
        """Words from this one on to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        begin = int(self.start[0])
        upto = np.append(self.start[1:], len(self.data))
        inside = np.arange(begin, len(self.data)) - np.repeat(self.start, upto - self.start)
        length = self.end - self.start
        # white space counts 0, so its place behind the word does not matter
        power = powers(_BASE, int((upto - self.start).max()))
        term = _BYTE[self.data[begin:]] * power[inside]
        return mix(np.add.reduceat(term, self.start - begin) + length.astype(np.uint64))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive values; the caller leaves out those that cross texts."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out *= _STEP
        out += hashes[i : i + size]
    return mix(out)


def spans(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the values from ``begin`` to ``end`` (exclusive) of each span, the same wherever the span stands."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_STEP, len(hashes) + 1)[: len(hashes)], dtype=np.uint64, out=total[1:])
    back = powers(_STEP_BACK, len(hashes) + 1)
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))


def by_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"):
    """A function for ``mapInArrow`` that gives ``fn`` a bounded amount of text at a time."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            yield fn(part)

    return go
