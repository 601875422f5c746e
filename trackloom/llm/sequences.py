"""Words, bytes and runs of them as numpy arrays, for code inside tasks.

A block is some documents laid end to end: ``data`` holds their UTF-8 bytes and ``offsets`` says where each one
begins (one entry more than documents). Nothing here looks across a document's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The white space that ends a word.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
BLOCK_BYTES = 1_000_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASES = {"bytes": 0x9E3779B97F4A7C15, "grams": 0xC2B2AE3D27D4EB4F}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, offsets) for runs of rows with about ``limit`` bytes; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes as they are."""
    return _LOWER[data]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and for each document the number of its first word."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    full = ~_IS_SPACE[data]
    gap = np.concatenate([[True], ~full, [True]])
    starts = np.flatnonzero(full & (gap[:-2] | edge[:-1]))
    ends = np.flatnonzero(full & (gap[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers spread over the whole word."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers_of(base: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for step in (_BASES[base], pow(_BASES[base], -1, 1 << 64)):
            row = np.full(size, step, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row, dtype=np.uint64))
        have = made[0], made[1]
        if size <= 4 * BLOCK_BYTES:  # those of a very long document aren't kept
            _powers[base] = have
    return have


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: str = "grams") -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each range, by differences of one running sum."""
    up, down = _powers_of(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[: len(values)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def rolling_hashes(values: np.ndarray, width: int, base: str = "grams") -> np.ndarray:
    """``range_hashes`` of every run of ``width`` values."""
    up, down = _powers_of(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[: len(values)], dtype=np.uint64, out=sums[1:])
    runs = sums[width:] - sums[:-width]
    runs *= down[: len(runs)]
    runs += np.uint64(width)
    return mixed(runs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(data.astype(np.uint64), starts, ends, "bytes")


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
