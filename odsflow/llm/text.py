"""Bytes, words and hashes of a text column, in numpy, batch by batch.

Spark partitions and shuffles the rows; these helpers run inside its tasks, on
one Arrow batch at a time, and never build a Python string per word. Word
hashes are polynomial in the bytes (table and base are odd 64-bit constants out
of a fixed seed) and mixed, so every task names a word alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20

#: The white space of a word's definition, `[\x20\x09-\x0D]`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_TABLES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(1, 2**62)) * 4 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept for the process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base & (2**64 - 1), np.uint64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES):
    """The batches cut into slices of about ``limit`` bytes of ``column``, whole rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // limit)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            yield batch.slice(low, high - low)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the rows' bounds in them; a null is empty."""
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "")
    width = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, places, data = array.buffers()
    bounds = np.frombuffer(places, width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray | None = None):
    """Starts and ends of the words, and each row's bounds among the words.

    ``gap`` says which bytes are outside words; white space by default.
    """
    gap = SPACE[data] if gap is None else gap
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    fresh = np.zeros(len(data) + 1, bool)
    fresh[bounds] = True
    inside = ~gap
    opens = inside & fresh[:-1]
    opens[1:] |= inside[1:] & gap[:-1]
    closes = inside & fresh[1:]
    closes[:-1] |= inside[:-1] & gap[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: int = 0) -> np.ndarray:
    """A 64-bit hash for each span of bytes; ``table`` 0 and 1 are independent."""
    running = np.zeros(len(data) + 1, np.uint64)
    values = _TABLES[table][data]
    values *= _power(_BASE, len(data))
    np.cumsum(values, out=running[1:])
    found = running[ends] - running[starts]
    found *= _power(_INVERSE, len(data) + 1)[starts]
    found += (ends - starts).astype(np.uint64)
    return mix(found)


def shingles(names: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` names in a row within one document, and the documents' bounds among them."""
    count = np.maximum(np.diff(bounds) - size + 1, 0)
    places = np.concatenate([[0], np.cumsum(count)])
    if not places[-1]:
        return np.zeros(0, np.uint64), places
    total = len(names) - size + 1
    rolled = np.zeros(total, np.uint64)
    for i in range(size):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += names[i : i + total]
    at = np.arange(places[-1]) + np.repeat(bounds[:-1] - places[:-1], count)
    return mix(rolled[at]), places


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + counts[i] - 1`` of all i, in order."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))
