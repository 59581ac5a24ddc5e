"""Numpy views of text columns: words, hashes and running sums over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits look random."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) made from well mixed 64-bit integers."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = pow(int(_BASE), -1, 1 << 64)
        _powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, _BASE)])
        _inverse_powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, np.uint64(inverse))])
    return _powers, _inverse_powers


def plain_strings(column: pa.Array) -> pa.Array:
    """The column as 64-bit offset strings, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text) without a copy of the bytes."""
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows that hold at most `limit` bytes, or one longer row."""
    data, offsets = raw_bytes(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings from `start` to `end`, A-Z lower-cased: differences of a rolling sum.

    Strings in order are hashed in runs of about SLICE_BYTES, so that sums and power tables stay small.
    """
    if len(data) > SLICE_BYTES and len(start) > 1 and (np.diff(start) >= 0).all():
        out = np.empty(len(start), np.uint64)
        low = 0
        while low < len(start):
            high = max(low + 1, int(np.searchsorted(start, start[low] + SLICE_BYTES // 2)))
            first, last = int(start[low]), int(end[low:high].max())
            out[low:high] = _hashes(data[first:last], start[low:high] - first, end[low:high] - first)
            low = high
        return out
    return _hashes(data, start, end)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    powers, inverse = _power_tables(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=prefix[1:])
    return mix64((prefix[end] - prefix[start]) * inverse[start])


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a run of texts: `start`, `end` (byte positions), `doc` and 64-bit `key` of the
    word with A-Z lower-cased. `first[d]:first[d+1]` are the words of text d. `strip` leaves up to three marks of
    punctuation at each end out of a word, but not its last character."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keys: bool = True, strip: bool = False):
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[: len(data)] = solid
        begins = edge[: len(data)].astype(bool)
        begins[1:] &= ~solid[:-1]
        inner = offsets[1:-1]
        inner = inner[inner < len(data)]
        begins[inner] |= solid[inner]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        cut = inner[inner > 0] - 1
        ends[cut] |= solid[cut]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        for _ in range(3 if strip else 0):
            self.start += _PUNCTUATION[data[self.start]] & (self.end - self.start > 1)
            self.end -= _PUNCTUATION[data[self.end - 1]] & (self.end - self.start > 1)
        if keys:
            self.key = hashes(data, self.start, self.end)


def word_counts(column: pa.Array) -> np.ndarray:
    parts = [Words(data, offsets, keys=False).count for _, data, offsets in slices(column)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def running(codes: np.ndarray, weights: np.ndarray, totals: dict) -> np.ndarray:
    """For each row the sum of the weights of earlier rows of its code, `totals` included and updated."""
    order = np.argsort(codes, kind="stable")
    sums = np.cumsum(weights[order])
    sorted_codes = codes[order]
    head = np.r_[True, sorted_codes[1:] != sorted_codes[:-1]] if len(order) else np.zeros(0, bool)
    begin = np.flatnonzero(head)
    before = np.r_[0, sums[:-1]] if len(order) else sums
    base = np.repeat(before[begin], np.diff(np.r_[begin, len(order)]))
    group = sorted_codes[begin]
    carried = np.repeat(
        np.array([totals.get(int(c), 0) for c in group], np.int64), np.diff(np.r_[begin, len(order)])
    )
    out = np.empty(len(order), np.int64)
    out[order] = before - base + carried
    last = np.r_[begin[1:], len(order)] - 1
    for c, b, e in zip(group, begin, last, strict=True):
        totals[int(c)] = totals.get(int(c), 0) + int(sums[e] - before[b])
    return out
