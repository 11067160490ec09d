"""Vectorised words and hashes over Arrow text columns.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  Every helper works on
the UTF-8 bytes of many documents at once, so there is no Python object per
word.  Text that is NULL counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a worker (one longer document is handled alone).
CHUNK_BYTES = 1 << 18

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two word hashes
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n`` (of the modular inverse if asked)."""
    have = _POWERS.get((base, inverse))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        p = np.full(size, pow(base, -1, 1 << 64) if inverse else base, dtype=np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if size <= 4 * CHUNK_BYTES:
            _POWERS[(base, inverse)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the n + 1 offsets of the rows."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` for runs of rows of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    data, offsets = text_buffer(column)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """Places of the words of a run of documents: ``starts``, ``ends`` (bytes), ``doc``, ``first`` (n + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~_SPACES[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
        self.data, self.offsets = data, offsets
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self, lower: bool = False, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` folds A-Z first."""
        base, data = _BASES[which], self.data
        if lower:
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data.astype(np.uint64) * powers(base, len(data)), out=total[1:])
        back = powers(base, len(data) + 1, True)
        size = (self.ends - self.starts).astype(np.uint64)
        return mix((total[self.ends] - total[self.starts]) * back[self.starts] + size * np.uint64(0xD6E8FEB86659FD93))

    def runs(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each word on, and whether they lie in one document."""
        n = len(hashes)
        out, valid = np.zeros(n, np.uint64), np.zeros(n, bool)
        if n >= k:
            total = np.zeros(n - k + 1, np.uint64)
            factor = powers(0xA0761D6478BD642F, k)
            for j in range(k):
                total += hashes[j : n - k + 1 + j] * factor[k - 1 - j]
            out[: n - k + 1] = mix(total + np.uint64(k))
            valid[: n - k + 1] = self.doc[: n - k + 1] == self.doc[k - 1 :]
        return out, valid


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
