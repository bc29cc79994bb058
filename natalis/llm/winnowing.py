"""Document fingerprints by winnowing.

Rolling hashes of all runs of ``gram`` code points; of every ``window`` consecutive hashes the smallest is
selected, the rightmost of equal ones, and kept with its position. Two texts that share a passage of
``gram + window - 1`` code points share a selected hash from it. A text shorter than a window has the
smallest hash it has; one shorter than a gram has the hash of its whole.

Defined results: a null text is empty, and an empty text has an empty fingerprint; equal texts have equal
fingerprints; likeness is the part of distinct selected hashes in common (Jaccard), 1 for two empty texts.
In the query, ids may repeat (equal ids are ordered by text) and a null id comes before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from natalis.llm.base import table
from natalis.llm.textarrays import PIECE, mixed, powers, slices

GRAM, WINDOW = 12, 29
BASE = np.uint64(0xD6E8FEB86659FD93)
#: Texts and bytes of text between two cuts of the order, about: what shares a task's memory.
ROWS, STRETCH_BYTES = 2000, 16 << 20
SLICE = 1 << 20


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` consecutive values, by doubling."""
    step, out = 1, values
    while 2 * step <= size:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = size - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of every run of ``gram`` code points."""
    n = len(points) - gram + 1
    out = np.empty(n, np.uint32)
    for at in range(0, n, PIECE):
        to = min(n, at + PIECE)
        up, down = powers(BASE, to - at + gram)
        sums = np.zeros(to - at + gram, np.uint64)
        np.cumsum((points[at : to + gram - 1].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        out[at:to] = mixed((sums[gram:] - sums[:-gram]) * down[: to - at]) >> np.uint64(32)
    return out


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected hashes and their positions, in order of position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = _hashes(points, min(gram, len(points)))
    size = min(window, len(hashes))
    picked = []
    for at in range(0, len(hashes) - size + 1, PIECE):
        part = hashes[at : at + PIECE + size - 1]
        # hash in the upper half, distance from the end in the lower: the minimum is the rightmost of equal hashes
        keys = part.astype(np.uint64) << np.uint64(32) | np.arange(len(part) - 1, -1, -1, dtype=np.uint64)
        chosen = _least(keys, size)
        chosen = chosen[np.append(True, chosen[1:] != chosen[:-1])]
        picked.append(at + len(part) - 1 - (chosen & np.uint64(0xFFFFFFFF)).astype(np.int64))
    positions = np.unique(np.concatenate(picked))
    return hashes[positions], positions


def joined(hashes: np.ndarray) -> str:
    """The selected hashes in order, eight hex digits each."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def fingerprints(docs: DataFrame, id_: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(id, hashes, positions) for every row: the selected hashes with the places (in code points) where they begin."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = [winnow(t or "", gram, window) for t in part.column("text").to_pylist()]
                columns = [part.column("id"), pa.array([f[0].astype(np.int64) for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "hashes", "positions"])

    rows = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(select, f"id {rows.schema['id'].dataType.simpleString()}, hashes array<long>, positions array<long>")


def _stretch(id_: Column, cuts: list[int]) -> Column:
    """The number of cuts that an id reaches; 0 for null."""
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def reached(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.int64), "right").astype(np.int32))

    return reached(F.coalesce(id_, F.lit(-(1 << 63))))


def with_next(docs: DataFrame, digest, fields: str, id_: str = "doc_id", text: str = "text", rows: int = ROWS) -> DataFrame:
    """``digest(id, text, next text)`` for every row, the next being the one of the next smaller id, the largest after the smallest.

    Ids are cut into stretches of about ``rows`` rows, or fewer where texts are long, at quantiles. Each stretch also gets a copy of the last
    row below it (the lowest: of the largest id), so that the texts are shuffled once and no task
    holds more than a stretch. The copied ids, one a stretch, are broadcast.
    """
    docs = docs.select(F.col(id_).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count, total = docs.agg(F.count("id"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    pieces = max(1, -(-count // rows), min(count, -(-total // STRETCH_BYTES)))
    cuts = docs.agg(F.percentile_approx("id", [k / pieces for k in range(1, pieces)], 100 * pieces)).first()[0] if pieces > 1 else []
    cuts = sorted(set(cuts or []))
    placed = docs.withColumn("stretch", _stretch(F.col("id"), cuts))
    last = placed.groupBy("stretch").agg(F.max("id").alias("id"), F.count("*").alias("n")).orderBy("stretch").collect()
    heirs = [(row["id"], last[(k + 1) % len(last)]["stretch"]) for k, row in enumerate(last)]
    heirs = docs.sparkSession.createDataFrame(heirs, "last long, heir int")
    copies = placed.join(F.broadcast(heirs), F.col("id").eqNullSafe(F.col("last"))).groupBy("heir").agg(F.max_by(F.struct("id", "text"), F.col("text")).alias("row"))
    copies = copies.select(F.col("row.id").alias("id"), F.col("row.text").alias("text"), F.col("heir").alias("stretch"), F.lit(True).alias("copy"))
    every = placed.select("id", "text", "stretch", F.lit(False).alias("copy")).union(copies)

    def fold(group: pa.Table) -> pa.Table:
        order = sorted(zip(group.column("copy").to_pylist(), group.column("id").to_pylist(), group.column("text").to_pylist(), strict=True), key=lambda r: (not r[0], r[1] is not None, r[1] or 0, r[2]))
        out = [digest(row[1], row[2], before[2]) for before, row in zip(order, order[1:], strict=False)]
        return pa.Table.from_pylist(out, schema)

    schema = to_arrow_schema(StructType.fromDDL(fields))
    return every.groupBy("stretch").applyInArrow(fold, fields)


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, with the positions of its hashes, and of its edited text, and their likeness."""

    def digest(id_: int, text: str, following: str) -> dict:
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        (own, places), changed, after = winnow(text), winnow(edited)[0], winnow(following)[0]
        return {
            "doc_id": id_,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": joined(own),
            "edited_fingerprint": joined(changed),
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, after),
            "positions": places.tolist(),
        }

    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>"
    return with_next(table(spark, sf_dir, "documents"), digest, fields)
