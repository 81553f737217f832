"""Words of whole texts as 64-bit hashes, for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once, so that the arrays stay in the cache.
BLOCK = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letters() -> np.ndarray:
    """Per byte whether it belongs to a word: ASCII letters and digits, and all beyond ASCII."""
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = table[ord("A") : ord("Z") + 1] = True
    table[ord("a") : ord("z") + 1] = table[128:] = True
    return table


def no_space() -> np.ndarray:
    """Per byte whether it is no ASCII white space."""
    table = np.ones(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return table


def hash_words(
    texts: list[bytes], table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` with A-Z lower-cased, and where they are.

    Returns the hashes, the byte buffer the texts were joined in, start and end of each
    word in it, and the bounds: text i has the words ``bounds[i]`` to ``bounds[i + 1]``.
    """
    buffer = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = table[buffer]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    bounds = np.searchsorted(starts, offsets)
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
    values[65:91] = values[97:123]
    hashes = np.empty(len(starts), np.uint64)
    longest = int((ends - starts).max(initial=0)) + BLOCK + 1
    powers = np.cumprod(np.full(min(longest, len(buffer) + 1), _FACTOR, np.uint64))
    inverse = np.cumprod(np.full(len(powers), pow(_FACTOR, -1, 1 << 64), np.uint64))
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        part = buffer[low : ends[last - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * powers[: len(part)], out=sums[1:])
        at, to = starts[first:last] - low, ends[first:last] - low
        hashes[first:last] = (sums[to] - sums[at]) * inverse[at]
        first = last
    return mix(hashes), buffer, starts, ends, bounds


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, across text bounds too."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total = total * np.uint64(_FACTOR) + hashes[j : j + n]
    return mix(total)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a text column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held a second time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def runs(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Split ``texts`` into runs of at most ``limit`` bytes, or of a single text."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if texts:
        yield low, len(texts)
