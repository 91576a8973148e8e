"""Texts as byte blocks, and words of such blocks as arrays.

Whatever runs in Python works on blocks of a few MB, so that its arrays stay small
however many rows an Arrow batch holds; a longer text is a block of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
#: Separators are 0, other bytes themselves with A-Z in lower case.
SPACE_WORDS = np.array(
    [0 if x == 32 or 9 <= x <= 13 else x + 32 * (65 <= x <= 90) for x in range(256)], np.uint8
)
#: Words of digits, letters and all bytes above ASCII.
ALNUM_WORDS = np.array(
    [x + 32 * (65 <= x <= 90) if chr(x).isalnum() or x > 127 else 0 for x in range(256)], np.uint8
)
_BASE = 0x9E3779B97F4A7C15


def blocks(
    texts: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of the rows' bytes from 0 on, bytes); NULL is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


@functools.lru_cache(maxsize=8)
def powers(length: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    inverse = pow(base, -1, 1 << 64)

    def row(x: int) -> np.ndarray:
        out = np.full(length, x, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)

    return row(base), row(inverse)


def scatter(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finisher of a common generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running(data: np.ndarray, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which :func:`spans` takes the hash of any span of *data*."""
    size = 1 << max(12, int(len(data)).bit_length())
    power, inverse = powers(size, base)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse[: len(data)], out=sums[1:])
    return sums, power


def spans(
    prefix: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """64-bit hashes of the spans; they depend on the bytes alone."""
    sums, power = prefix
    own = (sums[ends] - sums[starts]) * power[starts]
    return scatter(own + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def words(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a block; words end with their text."""
    kept = letters[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kept != 0
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, spans(running(kept), starts, ends)
