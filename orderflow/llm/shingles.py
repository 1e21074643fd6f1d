"""Distinct word shingles of many texts at once, as sorted 64-bit hashes in ragged numpy arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from orderflow.llm.common import offsets_of, string_buffers

SLICE_BYTES = 1 << 20  # text worked on at once; one longer text makes a slice of its own
LONG = 128  # bytes beyond which a word is hashed on its own
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every other."""
    h = h ^ np.uint64((salt * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every text, A-Z in lower case, and the offsets of the texts among them."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    begins = ~space
    begins[1:] &= space[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = ~space[edges]
    start = np.flatnonzero(begins)
    closed = ~space
    closed[:-1] &= space[1:]
    closed[offsets[1:][np.diff(offsets) > 0] - 1] = ~space[offsets[1:][np.diff(offsets) > 0] - 1]
    end = np.flatnonzero(closed) + 1
    total = np.concatenate(([np.uint64(0)], np.cumsum(_TABLE[data] * _powers(_BASE, len(data)), dtype=np.uint64)))
    h = (total[end] - total[start]) * _powers(_BACK, len(data) + 1)[start]
    h = mix(h + (end - start).astype(np.uint64), 1)
    # sums of powers modulo 2**64 can be alike for long words that are not
    for k in np.flatnonzero(end - start > LONG):
        h[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return h, np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text and their offsets; a text of fewer words is one shingle."""
    words, ends = word_hashes(data, offsets)
    counts = np.diff(ends)
    rolled = words.copy()
    for k in range(1, width):
        rolled[: max(0, len(words) - k)] = rolled[: max(0, len(words) - k)] * np.uint64(_BASE) + words[k:]
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(ends[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = rolled[at]
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.uint64(0)
        for w in words[ends[k] : ends[k + 1]]:
            value = np.uint64((int(value) * _BASE + int(w)) & ((1 << 64) - 1))
        h[np.searchsorted(owner, k)] = value + np.uint64(counts[k])
    h = mix(h, 2)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], offsets_of(np.bincount(owner[fresh], minlength=len(counts)))


def digests(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of every set; together they stand for the set."""
    out = []
    for salt in (3, 4):
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(sets, salt), dtype=np.uint64)))
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def slices(table: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the shingle sets of their texts."""
    _, ends = string_buffers(table.column(column))
    ends, start = ends[1:], 0
    while start < table.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        piece = table.slice(start, stop - start)
        yield piece, *shingle_sets(*string_buffers(piece.column(column)))
        start = stop
