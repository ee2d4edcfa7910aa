"""Words and hashes of whole Arrow string columns, computed on their bytes with numpy.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. All hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # text handled at once; a longer text is handled alone
CHUNK_ROWS = 512
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column on end, and where each row begins and ends; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of at most CHUNK_ROWS rows with at most ``limit`` bytes together, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n, row + CHUNK_ROWS)
        yield row, end
        row = end


LOWERED = _LOWER.astype(np.uint64) + U(1)  # what a byte counts in a word's hash; A-Z as a-z


class Words:
    """The words of some rows: where each begins and ends, its row, its hash, and each row's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, values: np.ndarray = LOWERED):
        self.rows = len(offsets) - 1
        word = ~_SPACE[data]
        before, after = np.empty_like(word), np.empty_like(word)
        if len(word):
            before[1:], after[:-1] = word[:-1], word[1:]
            filled = offsets[:-1][offsets[1:] > offsets[:-1]]
            before[filled] = False
            after[np.append(filled[1:], len(word)) - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # of each row; the last entry is the number of words
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.hash = self.hashed(data, values)

    def hashed(self, data: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A hash of each word in which byte b counts ``values[b]``."""
        up, down = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[:len(data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` entries from each place on, where there are as many; the entries are hashes themselves."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:len(h) - size + 1])


_PLACE = [U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3)]


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending within the row, and their rows.

    A row with fewer words has its whole sequence as the one shingle; a row without words has none.
    """
    h, counts = words.hash, np.diff(words.first)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    room = np.repeat(words.first[1:], counts) - np.arange(len(h))  # words from here to the row's end
    total = np.zeros(len(h), np.uint64)
    for j in range(size):
        shifted = np.zeros(len(h), np.uint64)
        shifted[:len(h) - j] = h[j:]
        total += np.where(room > j, (shifted + U(1)) * _PLACE[j % 5] * U(2 * (j // 5) + 1), U(0))
    begins = room >= size
    few = np.flatnonzero((counts > 0) & (counts < size))
    begins[words.first[few]] = True
    total[words.first[few]] += counts[few].astype(np.uint64) * U(0x2545F4914F6CDD1D)
    value, row = mix(total[begins]), words.row[begins]
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.uint16 if words.rows <= 1 << 16 else np.int64), kind="stable")]
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]
