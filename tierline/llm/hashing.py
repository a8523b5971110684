"""Vectorised 64-bit hashing of byte spans and words over whole Arrow columns.

A slice of a text column is one byte buffer with offsets. A prefix sum of
``mix(byte) * B**position`` (mod 2**64) gives the hash of any span in constant
time, whatever number of spans a text has. Hashes are equal across processes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class _Powers:
    """Powers of the base and of its inverse, grown to the longest slice met so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> None:
        if n >= len(self.up):
            size = max(n + 1, SLICE_BYTES + 1)
            for name, base in (("up", BASE), ("down", _INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


POWERS = _Powers()


class Prefix:
    """Prefix hashes of one byte buffer; ``values`` may replace the bytes' values (e.g. to fold case)."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> None:
        n = len(data)
        POWERS.need(n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * POWERS.up[:n], out=self.sums[1:], dtype=np.uint64)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position-free hashes of the spans ``[start, end)``."""
        raw = (self.sums[end] - self.sums[start]) * POWERS.down[start]
        return mix(raw + (end - start).astype(np.uint64) * BASE)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """As ``spans``, without the finaliser and the length: for spans of one length."""
        return (self.sums[end] - self.sums[start]) * POWERS.down[start]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds at most ``limit`` bytes; a longer text stands alone and whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def fold_ascii() -> np.ndarray:
    """Byte to byte: A-Z to a-z, all else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


class Words:
    """Words of a text column: maximal runs of bytes of ``kept``, cut at row ends, hashed with A-Z folded."""

    def __init__(self, column: pa.Array, kept: np.ndarray) -> None:
        self.data, self.offsets = text_bytes(column)
        fold = fold_ascii()
        inside = kept[self.data]
        n = len(inside)
        begins, ends = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        begins[:-1], ends[1:] = inside, inside
        begins[1:-1] &= ~inside[:-1]
        ends[1:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        if n and len(edges):
            joined = edges[inside[edges] & inside[edges - 1]]
            begins[joined] = ends[joined] = True
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        self.rows = np.searchsorted(self.start, self.offsets)
        self.hash = Prefix(self.data, BYTE_VALUES[fold]).spans(self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def grams(self, n: int) -> np.ndarray:
        """Hashes of ``n`` consecutive words by first word, also across rows; the last n - 1 words have none."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(m, np.uint64)
        for i in range(n):
            total += self.hash[i : i + m] * POWERS_OF_WORDS[i]
        return mix(total + _U(n))


POWERS_OF_WORDS = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, dtype=np.uint64), dtype=np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (block prefix and suffix minima)."""
    n = len(values)
    if n < width:
        return values[:0]
    if width == 1:
        return values
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark longs with the same bits."""
    return pa.array(x.view(np.int64))
