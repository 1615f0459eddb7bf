"""Words and word hashes of whole Arrow columns at once.

A word is a maximal run of bytes other than space and \\t..\\r, so it may hold any other character. A column is cut into
chunks of rows of a megabyte (one longer text is a chunk of its own), and each chunk is handled without a loop over
its texts. Hashes are 64-bit and depend on the bytes alone, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
KEPT_POWERS = CHUNK_BYTES + 4096  # longer tables are made when a long text needs them, and not kept
SPACES = b" \t\n\x0b\x0c\r"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit values: a bijection for each salt."""
    with np.errstate(over="ignore"):
        x = x.astype(_U) + _U((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_OF_BYTE = mix(np.arange(256), 7)
_powers = {_BASE: np.ones(1, _U), _UNBASE: np.ones(1, _U)}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    known = _powers[base]
    if len(known) < n:
        known = np.full(n if n > KEPT_POWERS else min(max(n, 2 * len(known)), KEPT_POWERS), base, _U)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= KEPT_POWERS:
            _powers[base] = known
    return known[:n]


class Chunk(NamedTuple):
    """Rows `start` to `stop` of a batch: their bytes, and where the words are.

    first: of each row the number of its first word, and at the end the number of words; starts, ends: byte positions.
    """

    start: int
    stop: int
    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """The row in the chunk of each word."""
        return np.repeat(np.arange(self.stop - self.start), self.counts)

    def hashes(self, head: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first `head` bytes."""
        ends = self.ends if head is None else np.minimum(self.ends, self.starts + head)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(_OF_BYTE[self.data] * powers(len(self.data)))])
            own = (sums[ends] - sums[self.starts]) * powers(len(self.data) + 1, _UNBASE)[self.starts]
            return mix(own + (ends - self.starts).astype(_U), head or 0)

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def words(self) -> list[bytes]:
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES, inside: np.ndarray = _IN_WORD) -> Iterator[Chunk]:
    """inside: for each byte whether it belongs to words."""
    data, offsets = utf8(column)
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        own = offsets[start : stop + 1] - offsets[start]
        part = data[offsets[start] : offsets[stop]]
        yield _cut(start, stop, _LOWER[part] if lower else part, own, inside)
        start = stop


def _cut(start: int, stop: int, data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray) -> Chunk:
    inside = of_word[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Chunk(start, stop, data, offsets, np.searchsorted(starts, offsets), starts, ends)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each start a hash of `size` neighbours; the last `size - 1` starts have none."""
    if len(hashes) < size:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * powers(len(hashes)))])
        return mix((sums[size:] - sums[:-size]) * powers(len(hashes), _UNBASE)[: len(sums) - size], size)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
