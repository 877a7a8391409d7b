"""Words and word hashes of whole batches of texts, computed on the bytes of the batch.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is what
``[^\\x20\\x09-\\x0D]+`` matches in UTF-8 text.  Hashes have 64 bits.  A word's eights of bytes are
scrambled one by one before they are added up, so words made of the same pieces in another order do
not meet; words of at most eight bytes and of one length never do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U = np.uint64
_MIX = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    h = (h ^ (h >> U(30))) * _MIX[0]
    h = (h ^ (h >> U(27))) * _MIX[1]
    return h ^ (h >> U(31))


_LENGTH = U(0x9E3779B97F4A7C15)
_FIRST = mixed(np.ones(1, np.uint64))
# Which bytes of an eight belong to a word that has so many left.
_PART = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, none of them empty."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = end - start
    total = mixed((eights[start] & _PART[np.minimum(size, 8)]) ^ _FIRST)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8
        first = np.cumsum(more) - more
        place = np.arange(more.sum()) - np.repeat(first, more) + 1
        at, left = np.repeat(start[long], more) + 8 * place, np.repeat(size[long], more) - 8 * place
        part = (eights[at] & _PART[np.minimum(left, 8)]) ^ mixed(place.astype(np.uint64) + U(1))
        total[long] += np.add.reduceat(mixed(part), first)
    return mixed(total + size.astype(np.uint64) * _LENGTH)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows in a row, offsets of the rows); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    return whole[start : int(offsets[-1])], offsets - start


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


@dataclass
class Words:
    """Words of a block: byte ranges, hashes, and for each row the range of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Words of the rows of one block; ``offsets`` count from the block's first byte."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~IS_SPACE[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    return Words(start, end, word_hashes(_LOWER[data] if lower else data, start, end), np.searchsorted(start, offsets))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the windows of ``size`` words, per row the range of its windows).

    A row with words, but fewer than ``size``, has one window: the whole row.
    """
    h, first = words.hash, words.first
    n = np.diff(first)
    total = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for k in range(size):
        total += h[k : k + len(total)] * U(2 * k * k + 6 * k + 7)
    count = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
    bounds = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], count)
    short = np.flatnonzero((n > 0) & (n < size))
    out = np.zeros(bounds[-1], np.uint64)
    whole = np.ones(bounds[-1], bool)
    whole[bounds[short]] = False
    out[whole] = total[at[whole]]
    for row in short:
        part = h[first[row] : first[row + 1]]
        out[bounds[row]] = (part * U(3) ** np.arange(1, len(part) + 1, dtype=np.uint64)).sum() + U(len(part))
    return mixed(out), bounds
