"""Hard negatives by an R-tree packed sort-tile-recursive.

Vectors are packed into tiles of about ``TILE`` rows on Spark: slabs of the coordinate that varies most, and within
each slab runs of the next one, both by range partitioning with the id and the row's number behind them, so that equal
vectors never fill a tile. Inside a tile the next coordinates sort and cut the rows into pages of ``PAGE`` rows, and
``FANOUT`` pages make a node. The minimum bounding box of pages and nodes gives, interval by interval of its
coordinates, the least and the largest inner product with an anchor. The tiles are written to the shared folder.

Anchors are asked in blocks, one block for the anchors of each tile, against every tile. A block walks a tile by a best-first
queue: the box with the largest upper bound comes first, and a box is left out for an anchor if its bounds
lie outside the anchor's score window or its upper bound lies strictly below the k-th score found so far (k-th scores of the
block's own tile are known from the start). The first walk finds each anchor's positives, the second one for each
positive the negatives in its window. Every tile's finds are joined by their first ``k``.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; vectors
shorter than the longest are filled with zeros; components so large that a score could leave 64 bits are clamped; a row without
an id is no anchor, takes part as any other and comes last among equal scores; repeated rows are rows of their own;
an anchor without another row of its label, or without a row in a window, has no result row for it. An empty table has none.
Only id, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natalis.llm.base import stored, table

TILE, PAGE, FANOUT = 8192, 64, 16
#: Coordinates that sort the pages of a tile.
LOCAL = 4
#: Scores lie between these two.
NONE, MOST = -(1 << 62), 1 << 62
#: Positives of an anchor and negatives of a positive.
KEPT = 5
_LAST = (1 << 63) - 1
_PARTS = "ids binary, missing binary, labels binary, vectors binary, kind string, width int, firsts binary, low binary, high binary, own binary, least binary, most binary"
ROW = f"tile int, home int, {_PARTS}"
FIELDS = [part.split()[0] for part in ROW.split(", ")]


def str_pages(vectors: np.ndarray, coordinates: list[int], page: int = PAGE) -> list[np.ndarray]:
    """Row numbers of every page: slabs by the first coordinate, each cut by the next ones."""

    def cut(rows: np.ndarray, left: list[int]) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // page)
        if pages <= 1 or not left:
            yield from (rows[k : k + page] for k in range(0, len(rows), page))
            return
        slabs = max(1, round(pages ** (1 / len(left))))
        size = page * -(-pages // slabs)
        rows = rows[np.argsort(vectors[rows, left[0]], kind="stable")]
        for k in range(0, len(rows), size):
            yield from cut(rows[k : k + size], left[1:])

    return list(cut(np.arange(len(vectors)), coordinates))


def _narrow(vectors: np.ndarray) -> tuple[str, bytes]:
    """The vectors in the smallest integers that hold them."""
    most = int(np.abs(vectors).max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if most < 1 << (8 * int(k[2]) - 1))
    return kind, vectors.astype(kind).tobytes()


def exact(vectors: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floats where all inner products are exact in floats, else as 64-bit integers."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(other).max(initial=0)))
    kind = np.float64 if most * most * max(1, vectors.shape[1]) < 1 << 52 else np.int64
    return vectors.astype(kind), other.astype(kind)


@dataclass
class Tile:
    """The rows of a tile in the order of their pages; boxes of nodes stand before those of pages."""

    ids: np.ndarray
    missing: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    firsts: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def packed(cls, ids: np.ndarray, missing: np.ndarray, labels: np.ndarray, vectors: np.ndarray, coordinates: list[int]) -> Tile:
        pages = str_pages(vectors, coordinates)
        order = np.concatenate(pages)
        vectors = vectors[order]
        firsts = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
        low, high = np.minimum.reduceat(vectors, firsts[:-1]), np.maximum.reduceat(vectors, firsts[:-1])
        nodes = np.arange(0, len(pages), FANOUT)
        low, high = np.concatenate([np.minimum.reduceat(low, nodes), low]), np.concatenate([np.maximum.reduceat(high, nodes), high])
        return cls(ids[order], missing[order], labels[order], vectors, firsts, low, high)

    @classmethod
    def read(cls, row: dict) -> Tile:
        width = row["width"]
        of = lambda name, kind, *shape: np.frombuffer(row[name], kind).reshape(*shape) if shape else np.frombuffer(row[name], kind)
        return cls(of("ids", "<i8"), of("missing", "?"), of("labels", "<i8"), of("vectors", row["kind"], -1, width), of("firsts", "<i8"), of("low", "<i8", -1, width), of("high", "<i8", -1, width))

    def row(self, tile: int) -> dict:
        kind, vectors = _narrow(self.vectors)
        parts = {"ids": self.ids.astype("<i8"), "missing": self.missing, "labels": self.labels.astype("<i8"), "firsts": self.firsts.astype("<i8"), "low": self.low.astype("<i8"), "high": self.high.astype("<i8")}
        return {"tile": tile, "kind": kind, "vectors": vectors, "width": self.vectors.shape[1]} | {k: v.tobytes() for k, v in parts.items()}

    @property
    def nodes(self) -> int:
        return len(self.low) - len(self.firsts) + 1

    def children(self, node: int) -> range:
        return range(self.nodes + node * FANOUT, min(len(self.low), self.nodes + (node + 1) * FANOUT))


@dataclass
class Asked:
    """Questions to a tile: ``who`` is the vector's number; ``same`` asks for rows of the label, else for those of others;
    scores lie between ``least`` and ``most``; ``own`` is the row of the tile that is left out, or -1.
    """

    vectors: np.ndarray
    who: np.ndarray
    labels: np.ndarray
    same: bool
    least: np.ndarray
    most: np.ndarray
    own: np.ndarray


def search(tile: Tile, asked: Asked, k: int = KEPT) -> tuple[np.ndarray, np.ndarray]:
    """For every question the rows of the tile with the first k scores (-1 where there are fewer), and the scores."""
    plain, vectors = exact(tile.vectors, asked.vectors)
    low, high = tile.low.astype(vectors.dtype), tile.high.astype(vectors.dtype)
    above, below = np.maximum(vectors, 0), np.minimum(vectors, 0)
    upper, lower = above @ high.T + below @ low.T, above @ low.T + below @ high.T
    who, floor = asked.who, asked.least.astype(vectors.dtype)
    scores, rows = np.full((len(who), k), NONE, vectors.dtype), np.full((len(who), k), -1)
    ids = np.full((len(who), k), _LAST)
    queue: list[tuple[float, int]] = []

    def open_for(box: int) -> np.ndarray:
        return np.flatnonzero((upper[who, box] >= floor) & (lower[who, box] <= asked.most))

    def push(boxes: range) -> None:
        for box in boxes:
            some = open_for(box)
            if len(some):
                heappush(queue, (-upper[who[some], box].max(), box))

    push(range(tile.nodes))
    while queue:
        _, box = heappop(queue)
        if box < tile.nodes:
            push(tile.children(box))
            continue
        some = open_for(box)
        if not len(some):
            continue
        a, b = (int(tile.firsts[box - tile.nodes + side]) for side in (0, 1))
        names, number = np.unique(who[some], return_inverse=True)
        found = (vectors[names] @ plain[a:b].T)[number]
        fits = (tile.labels[a:b] == asked.labels[some, None]) == asked.same
        fits &= (found >= floor[some, None]) & (found <= asked.most[some, None]) & (np.arange(a, b) != asked.own[some, None])
        hit = fits.any(1)
        some, found, fits = some[hit], found[hit], fits[hit]
        if not len(some):
            continue
        all_scores = np.concatenate([scores[some], np.where(fits, found, NONE)], 1)
        all_ids = np.concatenate([ids[some], np.broadcast_to(tile.ids[a:b], found.shape)], 1)
        all_rows = np.concatenate([rows[some], np.where(fits, np.arange(a, b), -1)], 1)
        first = np.lexsort((all_ids, -all_scores))[:, :k]
        scores[some], ids[some], rows[some] = (np.take_along_axis(x, first, 1) for x in (all_scores, all_ids, all_rows))
        floor[some] = np.maximum(floor[some], scores[some, -1])
    return rows, scores


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = {"int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [pa.field(*part.split()[:1], schema[part.split()[1]]) for part in ROW.split(", ")]
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in FIELDS} for row in rows], pa.schema(fields))


def _known(vectors: DataFrame, id_: str, vector: str, label: Column) -> DataFrame:
    """(id, label, v): rows that take part, components in 256ths."""
    rows = vectors.select(F.col(id_).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v")).where(F.col("label").isNotNull() & F.col("v").isNotNull())
    sound = F.forall("v", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return rows.where(sound).withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * 256)))


def _widths(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Rows, width, and the coordinates in falling order of variance; what comes to the driver is as long as a vector."""
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    spread = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg((F.sum(F.col("x").cast("double") ** 2) - F.sum(F.col("x").cast("double")) ** 2 / n).alias("s"))
    order = [r["at"] for r in spread.orderBy(F.desc("s"), "at").collect()]
    return n, width, order


def index(vectors: DataFrame, id_: str, vector: str, label: Column) -> tuple[DataFrame, int]:
    """The tiles as stored rows, and how many there are."""
    rows = _known(vectors, id_, vector, label).withColumn("row", F.monotonically_increasing_id())
    n, width, order = _widths(rows)
    tiles = max(1, -(-n // TILE))
    slabs = max(1, round(tiles**0.5))
    limit = int(((1 << 61) / max(1, width)) ** 0.5)
    first, second = (F.coalesce(F.get("v", F.lit(order[k % len(order)])), F.lit(0)) if order else F.lit(0) for k in (0, 1))
    cuts = []
    if slabs > 1:  # as many as the square root of the tiles
        cuts = rows.select(F.percentile_approx(first, [k / slabs for k in range(1, slabs)]).alias("c")).first()["c"]
    slab = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < first)) if cuts else F.lit(0)
    dealt = rows.select("id", "label", "v", slab.alias("slab"), second.alias("second"), "row").repartitionByRange(tiles, "slab", "second", "id", "row")
    local = [order[k % len(order)] for k in range(2, 2 + LOCAL)] if order else []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        rows = pa.Table.from_batches(own)
        ids, lists = (pa.concat_arrays(rows.column(k).chunks) for k in ("id", "v"))
        sizes = np.diff(lists.offsets.to_numpy())
        table_ = np.zeros((len(lists), max(1, width)), np.int64)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        table_[np.repeat(np.arange(len(lists)), sizes), at] = np.clip(lists.flatten().to_numpy(), -limit, limit)
        packed = Tile.packed(ids.fill_null(_LAST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), rows.column("label").to_numpy(), table_, local)
        yield _batch([packed.row(TaskContext.get().partitionId())])

    return stored(dealt.select("id", "label", "v").mapInArrow(pack, ROW), "tiles"), tiles


def _blocks(tiles: DataFrame, every: int) -> DataFrame:
    """The anchors of every tile as one row, with the k-th score of their positives in their own tile."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tile = Tile.read(row)
                own = np.flatnonzero(~tile.missing & (tile.ids % every == 0))
                if not len(own):
                    continue
                asked = Asked(tile.vectors[own], np.arange(len(own)), tile.labels[own], True, np.full(len(own), NONE + 1), np.full(len(own), MOST), own)
                _, scores = search(tile, asked)
                kind, vectors = _narrow(tile.vectors[own])
                parts = {"ids": tile.ids[own], "labels": tile.labels[own], "own": own, "least": np.maximum(scores[:, -1].astype(np.int64), NONE + 1)}
                yield _batch([{"home": row["tile"], "kind": kind, "vectors": vectors, "width": row["width"]} | {k: v.astype("<i8").tobytes() for k, v in parts.items()}])

    return tiles.mapInArrow(rows, ROW)


def _walk(tiles: DataFrame, blocks: DataFrame, n_tiles: int, ask, fields: str) -> DataFrame:
    """What ``ask(tile, its number, block row)`` returns for every tile and block; a tile's row comes before the blocks that ask it."""
    to_all = blocks.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    rows = tiles.union(to_all.select(*tiles.columns)).repartition("tile").sortWithinPartitions("tile", F.col("home").asc_nulls_first())

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, number = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["home"] is None:
                    tile, number = Tile.read(row), row["tile"]
                elif number == row["tile"]:  # a tile without rows has none of its own
                    yield ask(tile, number, row)

    return rows.mapInArrow(answers, fields)


def _of(row: dict) -> tuple[np.ndarray, ...]:
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["width"])
    return vectors, *(np.frombuffer(row[k], "<i8") if row[k] is not None else None for k in ("labels", "own", "least", "most"))


def _answer(tile: Tile, home: int, own: np.ndarray, rows: np.ndarray, scores: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    question, at = np.nonzero(rows >= 0)
    row = rows[question, at]
    columns = {"home": np.full(len(row), home, np.int32), "own": own[question]} | {k: v[question] for k, v in more.items()} | {"score": scores[question, at].astype(np.int64)}
    arrays = [pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(tile.ids[row], mask=tile.missing[row])], names=[*columns, "id"])


def _firsts(found: DataFrame, *keys: str) -> DataFrame:
    """The first rows by score, then id, of every key, with their place."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {KEPT}")


def hard_negatives(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str | Column = "label", every: int = 100, share: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor (an id divisible by
    ``every``) and each of its first positives the first rows of other labels that score at least ``share`` percent of the
    positive and no more than it.
    """
    tiles, n_tiles = index(vectors, id_, vector, F.col(label) if isinstance(label, str) else label)
    blocks = stored(_blocks(tiles, every), "anchors")

    def positives(tile: Tile, number: int, row: dict) -> pa.RecordBatch:
        wanted, labels, own, least, _ = _of(row)
        here = own if row["home"] == number else np.full(len(own), -1)
        asked = Asked(wanted, np.arange(len(own)), labels, True, least, np.full(len(own), MOST), here)
        return _answer(tile, row["home"], own, *search(tile, asked))

    found = _walk(tiles, blocks, n_tiles, positives, "home int, own long, score long, id long")
    pairs = stored(_firsts(found, "home", "own"), "positives")
    # a block's windows: no more than the positives of the anchors of one tile
    windows = pairs.groupBy("home").agg(F.sort_array(F.collect_list(F.struct("own", "rank", "score"))).alias("w"))

    def with_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked = row.pop("w")
                own, rank, score = (np.array([w[k] for w in asked], np.int64) for k in ("own", "rank", "score"))
                number = np.searchsorted(np.frombuffer(row["own"], "<i8"), own)
                yield _batch([row | {"firsts": number.astype("<i8").tobytes(), "ids": rank.astype("<i8").tobytes(), "most": score.astype("<i8").tobytes()}])

    asking = stored(blocks.join(windows, "home").select(*blocks.columns, "w").mapInArrow(with_windows, ROW), "windows")

    def negatives(tile: Tile, number: int, row: dict) -> pa.RecordBatch:
        wanted, labels, own, _, most = _of(row)
        who, rank = np.frombuffer(row["firsts"], "<i8"), np.frombuffer(row["ids"], "<i8")
        least = -((-share * most) // 100)
        asked = Asked(wanted, who, labels[who], False, np.where(least <= most, least, MOST), most, np.full(len(who), -1))
        return _answer(tile, row["home"], own[who], *search(tile, asked), place=rank)

    found = _walk(tiles, asking, n_tiles, negatives, "home int, own long, place long, score long, id long")
    found = _firsts(found, "home", "own", "place")
    named = blocks.select("home", "own", "ids")

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, ids = np.frombuffer(row["own"], "<i8"), np.frombuffer(row["ids"], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), row["home"], np.int32)), pa.array(own), pa.array(ids)], names=["home", "own", "anchor_id"])

    anchors = named.mapInArrow(names, "home int, own long, anchor_id long")
    positive = pairs.select("home", "own", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    rows = found.join(positive.join(anchors, ["home", "own"]), ["home", "own", "place"])
    return rows.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def moved_label(id_: str = "vec_id", label: str = "label") -> Column:
    """The label, one further (of ten) where the id is divisible by 7."""
    return F.when(F.col(id_) % 7 == 0, (F.col(label).cast("long") + 1) % 10).otherwise(F.col(label))


def op13_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors of ``embeddings``."""
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved_label())


OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.r, b.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) AS rank, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.a = s.a WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
