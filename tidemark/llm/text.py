"""Words and their 64-bit hashes for a whole Arrow string column at once.

Texts lie one behind the other in Arrow's buffer, so classes, borders and hashes of all words
of many texts are a few NumPy passes over bytes. UTF-8 bytes of characters beyond ASCII are all
0x80 or more, so byte classes give the same words as the character classes they stand for.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text whose A-Z are lower-cased
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers = tuple(tables)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (splitmix64's last steps)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Chunk(NamedTuple):
    first: int  # row of the batch
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # borders of texts in data; one more than texts


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray  # borders of texts among words


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Runs of whole texts of about `limit` bytes; a longer text is a run of its own. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, len(column))
        yield Chunk(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def words(chunk: Chunk, kind: np.ndarray, fold: bool = True) -> Words:
    """Borders and hashes of the words of a chunk; no word reaches over the end of a text."""
    low = LOWER[chunk.data] if fold else chunk.data
    n = len(low)
    inside = kind[low]
    border = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < n)]
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside
    before[border] = False
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    after[border] = False
    start = np.flatnonzero(inside & ~before[:n])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return Words(start, end, h, np.searchsorted(start, chunk.offsets))


_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(chunk: Chunk, size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of `size` words; of all its words if there are fewer."""
    found = words(chunk, SPACED)
    h, borders = found.hash, found.offsets
    windows = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for j in range(size):
        windows += h[j : j + len(windows)] * _STEPS[j]
    windows = mix(windows)
    sets = []
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            sets.append(mix(np.array([(h[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
