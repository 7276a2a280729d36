"""Words of text columns as hashes: whole Arrow buffers at a time, in numpy.

A word is a longest run of "word bytes" of the UTF-8 text. Which bytes are word bytes is a table of
256 flags; every byte of a non-ASCII character has the same flag, so no character is ever cut.
Upper-case A-Z counts as lower case. Equal words have equal 64-bit hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer single text is worked on alone.
CHUNK_BYTES = 2 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """Flags of the word bytes: all but the given closed ranges of lower-cased text."""
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    table[65:91] = table[97:123]  # upper-case letters are as the lower-case ones they count for
    return table


#: Words are runs of anything but a blank or the controls from tab to carriage return.
SPACED = [(0x09, 0x0D), (0x20, 0x20)]
#: Words are runs of ASCII letters, digits and all non-ASCII characters.
ALPHANUMERIC = [(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole value (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = np.arange(256, dtype=np.uint64)
    values[65:91] = values[97:123]
    return mix((values + np.uint64(1)) * np.uint64(_ODD))


def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base & _MASK, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Hasher:
    """Hashes the words of text columns; made once per task."""

    BASE = 0xD1342543DE82EF95

    def __init__(self, separators: list[tuple[int, int]]):
        self.inside = byte_table(separators)
        self.values = _byte_values()
        self.inverse = pow(self.BASE, -1, 1 << 64)
        self.power, self.back = _powers(0, 1), _powers(0, 1)

    def words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and for each text the number of its first word (one more entry ends the last text)."""
        n = len(data)
        if n > len(self.power):
            self.power, self.back = _powers(n, self.BASE), _powers(n, self.inverse)
        inside = self.inside[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        border = starts[starts < n]
        first[border] = inside[border]
        at = np.flatnonzero(first)
        if len(at) == 0:
            return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
        parts = self.values[data]
        parts[~inside] = 0
        parts *= self.power[:n]
        hashes = mix(np.add.reduceat(parts, at) * self.back[at])
        return hashes, np.searchsorted(at, starts)


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most`` bytes: first row, end row, bytes, starts.

    Null counts as empty. No text is cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, also of those across texts; entry i begins at word i."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    factor = 1
    for j in range(k):
        factor = factor * _ODD & _MASK
        out += hashes[j : j + n] * np.uint64(factor)
    return mix(out + np.uint64(k))


def fold(values: np.ndarray) -> int:
    """One 64-bit hash of a sequence of hashes, its order and length included."""
    if len(values) == 0:
        return 0
    total = np.add.reduce(mix(values + np.uint64(len(values))) * (_powers(len(values), _ODD)))
    return int(mix(np.array([total], dtype=np.uint64))[0])
