"""Byte-level word splitting and word hashing inside Arrow batches.

All functions work on UTF-8 bytes. ``bytes.split()`` without an argument splits
on exactly 0x20 and 0x09-0x0D, and ``bytes.lower()`` maps exactly A-Z, so both
follow the word rules of the operators without a regular expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multiplier of the rolling polynomial hash (fixed, any odd number serves).
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordIds(dict):
    """Word -> dense id, with two independent 64-bit hashes kept per id.

    Grows by one entry per distinct word it has seen; make a new one per bounded
    unit of work (a pack, a shard, a batch).
    """

    def __init__(self) -> None:
        super().__init__()
        self._pending: list[bytes] = []
        self._hashes = np.empty((1 << 10, 2), np.uint64)
        self._known = 0

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        self[word] = i
        self._pending.append(xxhash.xxh3_128_digest(word))
        return i

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """(h1, h2) by id. New ids are appended to arrays that double, so calls stay cheap."""
        n = self._known + len(self._pending)
        if n > self._known:
            if n > len(self._hashes):
                grown = np.empty((max(n, 2 * len(self._hashes)), 2), np.uint64)
                grown[:self._known] = self._hashes[:self._known]
                self._hashes = grown
            self._hashes[self._known:n] = np.frombuffer(b"".join(self._pending), ">u8").reshape(-1, 2)
            self._pending, self._known = [], n
        return self._hashes[:n, 1], self._hashes[:n, 0]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive values, modulo 2**64.

    ``out[i] = sum_j h[i+j] * BASE**(width-1-j)``; empty when there are fewer
    values than ``width``. Windows across document borders are the caller's to
    mask.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, width):
        out *= BASE
        out += h[j:j + n]
    return out


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no or several chunks
            return [t for c in column.chunks for t in texts(c)]
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.Table]:
    """Arrow batches joined up to about ``max_bytes`` of text each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column(b.schema.get_field_index(text)).nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def table_batches(data: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_pydict(data, schema=schema).to_batches()
