"""Count-min sketches of chunks of documents, merged by cell range.

Every chunk of documents counts its values in a sketch of ``DEPTH`` rows of ``cells`` cells. Counts are
kept as 1 or "more", as only repetition is asked for, and only cells that are not zero are sent: sorted, as
differences of two bytes mostly. The sketches are merged by ranges of cells (shards), one aggregate each, and every
chunk gets one bit for each cell it sent: whether the merged count is at least two. A value is estimated
repeated if all its cells are. Collisions only raise counts, so no repeated value is missed.

The cells grow with the values (so the false estimates don't), and no sketch is ever in one place as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.llm.base import bucket
from natalis.llm.textarrays import mixed

DEPTH = 2
CELLS_PER_VALUE = 4
CHUNK_BYTES = 4 << 20
#: Values of one sketch row that share a merging task.
SHARD_VALUES = 1 << 20
SENT = "chunk int, shard long, n int, wide boolean, steps binary, more binary"
REPLY = "chunk int, shard long, bits binary"


class Layout:
    """Cells, shards and chunks for about so many bytes of text and values."""

    def __init__(self, text_bytes: int, values: int):
        self.chunks = max(1, -(-text_bytes // CHUNK_BYTES))
        self.bits = max(16, int(values * CELLS_PER_VALUE).bit_length())
        self.shard_bits = max(0, self.bits - 32, int(values // SHARD_VALUES).bit_length())

    def cells(self, values: np.ndarray, row: int) -> np.ndarray:
        return mixed(values ^ np.uint64(0x51ED270B * (row + 1))) >> np.uint64(64 - self.bits)


def by_chunk(docs: DataFrame, id_: str, text: str, chunks: int) -> DataFrame:
    """(chunk, id, text): documents dealt to chunks by their id."""
    return docs.select(bucket(F.col(id_), chunks).alias("chunk"), F.col(id_).alias("id"), F.col(text).alias("text"))


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    first = np.ones(len(sorted_values), bool)
    first[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(first)


def send(chunk: int, values: np.ndarray, layout: Layout) -> pa.Table:
    """The cells that a chunk's values touch, by shard."""
    out = {k: [] for k in ("chunk", "shard", "n", "wide", "steps", "more")}
    low_bits = layout.bits - layout.shard_bits
    for row in range(DEPTH):
        cells = np.sort(layout.cells(values, row))
        at = runs(cells)
        more = np.diff(np.append(at, len(cells))) > 1
        cells = cells[at]
        shards = cells >> np.uint64(low_bits)
        edges = np.append(runs(shards), len(cells))
        for a, b in zip(edges, edges[1:], strict=False):
            own = cells[a:b] & np.uint64((1 << low_bits) - 1)
            steps = np.diff(own, prepend=np.uint64(0))
            wide = bool(steps.max() > 0xFFFF)
            out["chunk"].append(chunk)
            out["shard"].append(int(row << layout.shard_bits | int(shards[a])))
            out["n"].append(int(b - a))
            out["wide"].append(wide)
            out["steps"].append(steps.astype(np.uint32 if wide else np.uint16).tobytes())
            out["more"].append(np.packbits(more[a:b]).tobytes())
    return pa.table({"chunk": pa.array(out["chunk"], pa.int32()), "shard": pa.array(out["shard"], pa.int64()), "n": pa.array(out["n"], pa.int32()), "wide": pa.array(out["wide"], pa.bool_()), "steps": pa.array(out["steps"], pa.binary()), "more": pa.array(out["more"], pa.binary())})


def merge(group: pa.Table) -> pa.Table:
    """The sum of the sketches of a shard; for every sender one bit for each of its cells."""
    cells, weights = [], []
    for n, wide, steps, more in zip(*(group.column(k).to_pylist() for k in ("n", "wide", "steps", "more")), strict=True):
        cells.append(np.cumsum(np.frombuffer(steps, np.uint32 if wide else np.uint16), dtype=np.uint32))
        weights.append(np.unpackbits(np.frombuffer(more, np.uint8), count=n) + 1)
    return replies(group, np.concatenate(cells), np.concatenate(weights))


def replies(group: pa.Table, *columns: np.ndarray) -> pa.Table:
    """Bits for the rows of a group: whether the weights of equal keys sum up to at least two. The last column has the weights."""
    *keys, weights = columns
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    at = np.flatnonzero(first)
    total = np.add.reduceat(weights[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    flags = np.empty(len(order), bool)
    flags[order] = np.repeat(total >= 2, np.diff(np.append(at, len(order))))
    ends = np.cumsum(group.column("n").to_numpy())
    bits = [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, group.column("n").to_numpy(), strict=True)]
    return pa.table({"chunk": group.column("chunk"), "shard": group.column("shard"), "bits": pa.array(bits, pa.binary())})


def estimated(values: np.ndarray, layout: Layout, reply: dict[int, bytes]) -> np.ndarray:
    """Which of a chunk's values are estimated repeated, from the bits that came back by shard."""
    out = np.ones(len(values), bool)
    low_bits = layout.bits - layout.shard_bits
    for row in range(DEPTH):
        cells = layout.cells(values, row)
        order = np.argsort(cells)
        cells = cells[order]
        at = runs(cells)
        shards = cells[at] >> np.uint64(low_bits)
        edges = np.append(runs(shards), len(at))
        flags = [np.unpackbits(np.frombuffer(reply[int(row << layout.shard_bits | int(shards[a]))], np.uint8), count=int(b - a)) for a, b in zip(edges, edges[1:], strict=False)]
        if flags:
            out[order] &= np.repeat(np.concatenate(flags).astype(bool), np.diff(np.append(at, len(cells))))
    return out
