"""Words, rolling hashes and their windows as NumPy arrays over Arrow columns of texts.

All functions take a batch of texts as one array of UTF-8 bytes with the offset of every text, and
go through it in pieces, so that temporary arrays stay small however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
BASE, BASE_TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WHOLE = 1 << 64


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, _WHOLE))


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of base and of its inverse, modulo 2 to the 64; kept for pieces of the usual size."""
    if n > PIECE + 4096:
        return _powers(base, n), _powers(_inverse(base), n)
    if int(base) not in _TABLES:
        _TABLES[int(base)] = _powers(base, PIECE + 4096), _powers(_inverse(base), PIECE + 4096)
    up, down = _TABLES[int(base)]
    return up[:n], down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(table: pa.RecordBatch | pa.Table, column: str, most: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """The rows in order, in slices of about ``most`` bytes of text; a longer text has a slice of its own."""
    if not table.num_rows:
        return
    _, offsets = flat(table.column(column))
    at = 0
    while at < table.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield table.slice(at, to - at)
        at = to


def table_of(wanted: bytes | range) -> np.ndarray:
    """256 flags: which bytes belong to a word."""
    out = np.zeros(256, bool)
    out[list(wanted)] = True
    return out


SPACES = bytes([0x20, *range(0x09, 0x0E)])
SPACED = ~table_of(SPACES)  # words are runs of anything but blanks
ALNUM = table_of([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and for every text the number of its first word (n + 1 values)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; starts and ends ascend."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        up, down = powers(base, high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mixed(out)


def window_hashes(values: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` values, runs over the edges of texts included."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, PIECE // 4):
        to = min(n, at + PIECE // 4)
        part = values[at : to + size - 1]
        up, down = powers(base, len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:-1], out=sums[1:])
        out[at:to] = (sums[size:] - sums[:-size]) * down[: to - at]
    return mixed(out)


def whole(firsts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the n windows lie in one text; firsts: number of the first value of every text (and the end)."""
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(firsts[-1])
    return left[:n] >= size


def covered(marked: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n values lie in a marked window of ``size`` values; marked has a flag for every window start."""
    at = np.flatnonzero(marked)
    edges = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + size, minlength=n + 1)[: n + 1]
    return np.cumsum(edges[:-1]) > 0
