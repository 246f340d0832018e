"""64-bit hashes of words, shingles and byte windows, on whole Arrow columns.

A batch is worked through in chunks of some MB of text, so that memory does not
follow the batch. All hashes are fixed functions of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
FOLD = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    up = np.full(n, BASE, dtype=np.uint64)
    down = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(1 << max(20, (n + 1).bit_length()))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = powers_for(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` bytes, by position."""
    if len(data) < width:
        return np.empty(0, dtype=np.uint64)
    _, down = powers_for(len(data))
    sums = prefix_sums(data)
    return mix((sums[width:] - sums[:-width]) * down[: len(data) - width + 1])


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, their bytes and the offsets of the rows in them; null is empty.

    A row longer than ``most`` makes a chunk of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else column.type)
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of some texts, and where each text's words start.

    A word is a run of bytes other than ASCII white space, and only A-Z are
    lower-cased.
    """
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    low, inside = LOWER[data], ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))
    starts = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
    after = np.concatenate((inside, [False]))
    ends = np.flatnonzero(inside & (~after[1:] | edge[1:])) + 1
    _, down = powers_for(len(data))
    sums = prefix_sums(low)
    found = (sums[ends] - sums[starts]) * down[starts]
    return mix(found ^ mix((ends - starts).astype(np.uint64))), np.searchsorted(starts, offsets)


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, by position."""
    if len(words) < width:
        return np.empty(0, dtype=np.uint64)
    n = len(words) - width + 1
    total = words[:n].copy()
    for k in range(1, width):
        total = total * FOLD + words[k : n + k]
    return mix(total ^ np.uint64(width))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words has its whole sequence as its one shingle, and one
    without words has none.
    """
    for _, _, data, offsets in text_chunks(column):
        words, at = word_hashes(data, offsets)
        grams = fold(words, width)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= width:
                own = np.sort(grams[a : b - width + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            else:
                yield fold(words[a:b], b - a) if b > a else np.empty(0, dtype=np.uint64)
