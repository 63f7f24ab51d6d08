"""Helpers over Arrow string columns: raw bytes, passages and word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multiplier of the rolling hash; its inverse modulo 2**64 exists.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and the offsets of each; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``limit`` bytes; a longer text is a slice of its own."""
    _, at = utf8(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
        yield begin, texts.slice(begin, end - begin)
        begin = end


def passages(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts into even passages of up to ``size`` bytes: text index, first and last byte.

    An empty text has one empty passage.
    """
    lengths = np.diff(at)
    count = np.maximum(1, -(-lengths // size))
    text = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = at[:-1][text] + nth * lengths[text] // count[text]
    return text, begin, at[:-1][text] + (nth + 1) * lengths[text] // count[text]


def groups(begin: np.ndarray, end: np.ndarray, limit: int = 1 << 20) -> Iterator[slice]:
    """Consecutive passages of about ``limit`` bytes together."""
    first = 0
    while first < len(begin):
        last = max(first + 1, int(np.searchsorted(end, begin[first] + limit, "right")))
        yield slice(first, last)
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            _POWERS[size] = tuple(
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
                for b in (BASE, INVERSE))
    return _POWERS[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values over their range (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over all bytes."""
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross a text's end: begin, end, text index."""
    n = len(inside)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return begin, end, np.searchsorted(at, begin, "right") - 1
