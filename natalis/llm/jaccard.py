"""Jaccard join of word n-gram sets, light sets by their subsets and heavy sets by inverted lists.

A document is the set of its distinct shingles of ``words`` words (A-Z lower-cased); equal sets are one node. Two sets of
a and b shingles are as similar as ``share`` percent if and only if they have ``required(a, b)`` shingles in common.

Light sets (up to a boundary of shingles) enumerate all their subsets of the fixed sizes that some other light set may
require. Two light sets are linked if and only if they have such a subset in common, so equal keys are links
without any verification, and a key's members are linked with one representative of each size: no pair is a row.

Heavy sets are looked up in inverted lists. A list holds the sets that have a shingle among their rarest ones: so
many as a linked set may lack, and one more; every linked pair meets in a list. Three steps keep a large group of
near copies from being compared pair by pair. First a few lists of every set are cut into blocks at random, and each block gives
a tree of its closest candidates. Then lists are scanned only between sets of different components. A list that
still has too many such pairs is split by a second shingle (linked sets share two of their rarest ones and one more), and what
remains crowded there is compared in blocks, all against all. Every candidate pair passes two filters that lose
none, by size and by the differing bits of a parity sketch, and is verified on its full sets.

The boundary is the one of least cost: rows of subsets for the sizes below against the lengths of the lists scanned for those
above, both counted over all sets.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and is its own component; a
text with fewer words than a shingle has its word sequence as its only shingle; rows of equal id are one document that
has the links of each; a null id is linked with nothing and has a null component. Only id and text are read.
Sets are compared by 64-bit hashes of their shingles, subsets and equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natalis.llm.base import connected, cut, stored, table
from natalis.llm.near import BROADCAST_IDS, SLICE, _groups, _sorted_map, shingle_sets, verified
from natalis.llm.textarrays import mixed, slices

WORDS, SHARE = 5, 80
#: Sets above this size have too many subsets to be light at any cost of the lists.
MOST_LIGHT = 16
#: Cells in which shingles are counted to tell rare ones; the order is one for all sets, however full the cells.
CELL_BITS = 18
#: Bits of a parity sketch, at least: beyond, sketches have one for every two shingles, as a short one tells no large sets apart.
SKETCH = 1024
#: Lists by which a set is joined first: so many of its rarest shingles with a list, and so many of its commonest.
FIRST_LISTS = 2
#: Members of a list that are compared together in the first step; members of a block of a long list.
TOGETHER, BLOCK = 512, 1024
#: Pairs of different components for each member up to which a list is scanned as it is.
PAIRS = 256
#: Regions before its own that a row knows, to tell pairs that were met there.
EARLIER = 16
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def required(a, b, share: int = SHARE):
    """Common shingles from which sets of a and b are linked."""
    return -(-share * (a + b) // (100 + share))


def subset_sizes(n: int, boundary: int, share: int = SHARE) -> list[int]:
    """The sizes of subsets by which a light set of n shingles meets others up to the boundary."""
    partners = range(-(-share * n // 100), min(boundary, 100 * n // share) + 1)
    return sorted({required(n, other, share) for other in partners})


def rarest_count(n, share: int = SHARE):
    """The rarest shingles of a set of which any linked set must have one."""
    return n + 1 + (-share * n) // 100


def boundary_of_least_cost(light_sets: dict[int, int], scans: dict[int, int], share: int = SHARE, most: int = MOST_LIGHT) -> int:
    """The size up to which sets are light: rows of subsets of the sets below and entries scanned for those above cost the same."""

    def cost(boundary: int) -> int:
        rows = sum(light_sets.get(n, 0) * sum(comb(n, k) for k in subset_sizes(n, boundary, share)) for n in range(1, boundary + 1))
        return rows + sum(scans.get(n, 0) for n in range(boundary + 1, most + 1))

    return min(range(most + 1), key=lambda b: (cost(b), b))


@cache
def _choices(n: int, size: int) -> np.ndarray:
    return np.array(list(combinations(range(n), size)), np.int64)


def _sketch(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each of ``SKETCH`` cells or of a larger power of two."""
    cells = max(SKETCH, 1 << max(len(shingles) // 2 - 1, 0).bit_length())
    odd = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """The sketches of the same sets in fewer cells, of so many bytes: a row of numbers each."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width // 8), axis=0) for s in sketches])


def _described(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, one, two, sketch): set size, 128 bits that tell sets apart, and the parity sketch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = list(shingle_sets(part, "text", size))
                sums = [[int(mixed(s * f).sum(dtype=np.uint64).astype(np.int64)) for s in sets] for f in (np.uint64(1), _GOLDEN)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.int64()) for x in sums), pa.array([_sketch(mixed(s)) for s in sets], pa.binary())], names=["id", "n", "one", "two", "sketch"])

    return docs.mapInArrow(rows, "id long, n long, one long, two long, sketch binary")


def _of(docs: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """The documents with the given ids; no text is shuffled for up to ``BROADCAST_IDS`` of them."""
    return docs.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, "id", "left_semi")


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _cell_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many shingles of all sets lie in each cell; as many numbers as cells come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                total += np.bincount(_cells(np.concatenate(list(shingle_sets(part, "text", size)))), minlength=1 << CELL_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    found = docs.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return counts


def _postings(docs: DataFrame, size: int, share: int, counts: np.ndarray) -> DataFrame:
    """(id, n, rank, shingle, weight): every set's rarest shingles and one more, rarest first, and the sets they are counted in.

    Rare by counts in cells, equal counts by hash, so that all sets have the same order.
    """
    usual = int(counts.sum()) >> CELL_BITS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = list(shingle_sets(part, "text", size))
                first = []
                for s in sets:
                    order = np.lexsort((s, counts[_cells(s)]))[: rarest_count(len(s), share) + 1 if len(s) else 0]
                    first.append(s[order])
                kept = np.array([len(f) for f in first], np.int64)
                shingles = np.concatenate([np.zeros(0, np.uint64), *first])
                ids = part.column("id").take(pa.array(np.repeat(np.arange(len(sets)), kept)))
                rank = np.arange(len(shingles)) - np.repeat(np.cumsum(kept) - kept, kept)
                n = np.repeat(np.array([len(s) for s in sets], np.int64), kept)
                weight = np.maximum(counts[_cells(shingles)] - usual, 1)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in (n, rank, shingles.astype(np.int64), weight))], names=["id", "n", "rank", "shingle", "weight"])

    return docs.mapInArrow(rows, "id long, n long, rank long, shingle long, weight long")


def light_links(docs: DataFrame, boundary: int, size: int = WORDS, share: int = SHARE) -> DataFrame:
    """(a, b): links that connect what is linked among sets up to the boundary."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found: list[tuple[np.ndarray, ...]] = []
                for id_, s in zip(part.column("id").to_pylist(), shingle_sets(part, "text", size), strict=True):
                    if not 0 < len(s) <= boundary:
                        continue
                    one, two = mixed(s), mixed(s * _GOLDEN)
                    for k in subset_sizes(len(s), boundary, share):
                        chosen = _choices(len(s), k)
                        keys = one[chosen].sum(1, dtype=np.uint64), two[chosen].sum(1, dtype=np.uint64)
                        found.append((np.full(len(chosen), id_), np.full(len(chosen), len(s)), np.full(len(chosen), k), *keys))
                if found:
                    columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "size", "one", "two"])

    key = ["size", "one", "two"]
    members = cut(docs.mapInArrow(rows, "id long, n long, size long, one long, two long"))
    sizes = members.groupBy(*key, "n").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    # as many entries as there are light sizes
    shared = sizes.groupBy(*key).agg(F.collect_list(F.struct("n", "id")).alias("sizes"), F.min("id").alias("low"), F.max("last").alias("high")).where("low < high")
    fits = F.expr(f"filter(sizes, s -> s.id <> id and {share} * (s.n + n) <= {100 + share} * size)")
    found = members.join(shared.select(*key, "sizes"), key).select("id", F.explode(fits).alias("s"))
    return found.select(F.least("id", "s.id").alias("a"), F.greatest("id", "s.id").alias("b")).distinct()


def _pairs(region: np.ndarray, n: np.ndarray, sketches: list[bytes], share: int, boundary: int, component: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers i, j of one region that may be linked, and their differing bits: one is heavy, components differ, and
    neither sizes nor sketches rule them out. A set's parity differs in no more cells than it has differing shingles.
    Two sketches are compared in the cells of the shorter one.
    """
    widths = np.array([len(s) for s in sketches])
    for width in np.unique(widths).tolist():
        short = widths == width
        rows = np.flatnonzero(short | ((widths > width) & (share * n <= 100 * n[short].max())))
        bits = _folded([sketches[r] for r in rows], width)
        parts = None if component is None else component[rows]
        for i, j, differ in _near(region[rows], n[rows], bits, short[rows], share, boundary, parts):
            yield rows[i], rows[j], differ


def _near(region: np.ndarray, n: np.ndarray, bits: np.ndarray, short: np.ndarray, share: int, boundary: int, component: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of ``_pairs`` of which one is ``short``, by sketches of equal width."""
    last = np.searchsorted(region, region, "right")
    i = np.arange(len(region))
    for step in range(1, len(region)):
        i = i[i + step < last[i]]
        if not len(i):
            return
        j = i + step
        may = (short[i] | short[j]) & (100 * np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j])) & (np.maximum(n[i], n[j]) > boundary)
        if component is not None:
            may &= component[i] != component[j]
        a, b = i[may], j[may]
        if len(a):
            differ = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
            close = differ <= n[a] + n[b] - 2 * required(n[a], n[b], share)
            if close.any():
                yield a[close], b[close], differ[close]


def forest(i: np.ndarray, j: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """The numbers of the edges (i, j) between n nodes that make a shortest forest of what they connect.

    Every tree takes its shortest edge to another tree at once, until there is none.
    """
    label, edge, kept = np.arange(n), np.arange(len(i)), []
    while len(edge):
        a, b = label[i[edge]], label[j[edge]]
        edge = edge[a != b]
        a, b = a[a != b], b[a != b]
        if not len(edge):
            break
        ends, both = np.concatenate([a, b]), np.concatenate([edge, edge])
        order = np.lexsort((both, length[both], ends))
        taken = np.unique(both[order[np.append(True, ends[order][1:] != ends[order][:-1])]])
        kept.append(taken)
        up = np.arange(n)
        for x, y in zip(label[i[taken]].tolist(), label[j[taken]].tolist(), strict=True):
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            up[max(x, y)] = min(x, y)
        while (up[up] != up).any():
            up = up[up]
        label = up[label]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _trees(rows: DataFrame, share: int, boundary: int) -> DataFrame:
    """(a, b): a forest of every region's candidates, those with the fewest differing bits first."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "region"):
            region, ids, n = (group.column(k).to_numpy() for k in ("region", "id", "n"))
            found = list(_pairs(region, n, group.column("sketch").to_pylist(), share, boundary))
            if found:
                i, j, differ = (np.concatenate(x) for x in zip(*found, strict=True))
                kept = forest(i, j, differ, len(ids))
                a, b = ids[i[kept]], ids[j[kept]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return _sorted_map(rows, "region", trees, "a long, b long").where("a < b").distinct()


def _known(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The earlier regions of every row, side by side, and which of these places are taken."""
    lists = group.column("earlier").combine_chunks()
    taken = np.arange(EARLIER) < lists.value_lengths().to_numpy()[:, None]
    out = np.zeros(taken.shape, np.int64)
    out[taken] = lists.flatten().to_numpy()
    return out, taken


def _across(rows: DataFrame, share: int, boundary: int) -> DataFrame:
    """(a, b): candidate pairs of different components, given by the first region in which the two meet.

    In a region a pair of equal sides is left to another block of the same region, and one with an earlier region in common to
    that one; a pair whose common regions all lie further back is given again. Rows without sides and earlier regions are all compared.
    """
    plain = {"earlier": F.array().cast("array<long>"), "side": F.lit(-1)}
    rows = rows.withColumns({name: value for name, value in plain.items() if name not in rows.columns})

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "region"):
            region, ids, n, component, side = (group.column(k).to_numpy() for k in ("region", "id", "n", "component", "side"))
            earlier, taken = _known(group)
            for i, j, _ in _pairs(region, n, group.column("sketch").to_pylist(), share, boundary, component):
                own = (side[i] != side[j]) | (side[i] < 0)
                i, j = i[own], j[own]
                met = ((earlier[i][:, :, None] == earlier[j][:, None, :]) & taken[i][:, :, None] & taken[j][:, None, :]).any((1, 2))
                i, j = i[~met], j[~met]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["a", "b"])

    return _sorted_map(rows, "region", pairs, "a long, b long").distinct()


def _with_sketches(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    return rows.join(nodes.select("id", "n", "sketch"), "id").select("region", *(c for c in rows.columns if c != "region"), "n", "sketch")


def _shared(postings: DataFrame, share: int, boundary: int) -> DataFrame:
    """The postings of which another one of the same shingle has a size that allows a link with a heavy set.

    In a list sorted by size a row's neighbours are the closest to it, so no list is held as a whole.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, with_last = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table_ = pa.Table.from_batches([batch] if held is None else [held, batch])
            shingles, n = table_.column("shingle").to_numpy(), table_.column("n").to_numpy()
            again = np.append(False, (shingles[1:] == shingles[:-1]) & (100 * n[:-1] >= share * n[1:]) & (n[1:] > boundary))
            again[0] = with_last
            keep = again | np.append(again[1:], False)
            held, with_last = table_.slice(table_.num_rows - 1).to_batches()[0], bool(again[-1])
            keep[-1] = False  # told when the next row is known
            yield from table_.filter(pa.array(keep)).to_batches()
        if held is not None and with_last:
            yield held

    fields = "id long, n long, rank long, shingle long"
    return _sorted_map(postings.select("id", "n", "rank", "shingle"), "shingle", rows, fields, "n")


def _first_lists(lists: DataFrame) -> DataFrame:
    """(region, id): members of a few lists of every set, each list in blocks by chance."""
    own = Window.partitionBy("id")
    some = lists.withColumn("k", F.row_number().over(own.orderBy("rank"))).withColumn("m", F.count("*").over(own))
    some = some.where(f"k <= {FIRST_LISTS} or k > m - {FIRST_LISTS}").select("shingle", "id")
    blocks = some.groupBy("shingle").agg(F.ceil(F.count("*") / TOGETHER).alias("blocks"), F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    return some.join(blocks.select("shingle", "blocks"), "shingle").select(F.xxhash64("shingle", F.pmod(F.xxhash64("id", "shingle"), "blocks")).alias("region"), "id")


def _measured(rows: DataFrame) -> DataFrame:
    """The rows (region, id, n, component) of regions of several components, with size, largest component, and whether the pairs fit."""
    parts = rows.groupBy("region", "component").agg(F.count("*").alias("c"))
    stats = parts.groupBy("region").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max_by("component", F.struct("c", "component")).alias("major"), F.count("*").alias("parts"))
    m = F.col("m")
    stats = stats.where("parts > 1").select("region", "m", "major", ((m * m - F.col("squares")) <= 2 * PAIRS * m).alias("fits"))
    return cut(rows.join(stats, "region"))


def _with_earlier(measured: DataFrame) -> DataFrame:
    """The rows with the regions that come just before their own among those of their id; all regions in which ids meet are given."""
    before = Window.partitionBy("id").orderBy("region").rowsBetween(-EARLIER, -1)
    # rows of equal id and region aren't earlier than each other
    return measured.withColumn("earlier", F.collect_list("region").over(before)).withColumn("earlier", F.expr("filter(earlier, r -> r < region)"))


def _dealt(measured: DataFrame) -> DataFrame:
    """(region, id, component, earlier, side) of measured regions in blocks.

    Of regions that fit, members of the largest component are dealt to blocks and the few others are in each of them; of others, every
    two blocks share a region. Two rows are met here if their sides differ or are -1; other pairs meet in another block.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = measured.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("large", F.col("component") == F.col("major"))
    cells = """
        CASE WHEN fits AND large THEN array(struct(block AS low, block AS high, 0 AS side))
             WHEN fits THEN transform(sequence(0, blocks - 1), o -> struct(o AS low, o AS high, IF(o = 0, -1, 1) AS side))
             ELSE transform(sequence(0, blocks - 1), o -> struct(least(block, o) AS low, greatest(block, o) AS high, CASE WHEN block = o THEN -1 WHEN block < o THEN 0 ELSE 1 END AS side)) END"""
    rows = rows.select("region", "id", "component", "earlier", F.explode(F.expr(cells)).alias("cell"))
    return rows.select(F.xxhash64("region", "cell.low", "cell.high").alias("region"), "id", "component", "earlier", F.col("cell.side").alias("side"))


def _by_two(crowded: DataFrame, postings: DataFrame, components: DataFrame) -> DataFrame:
    """(region, id, n, component): members of crowded lists by their list's shingle and every other of their rarest and one more."""
    named = crowded.select("id", F.col("region").alias("shared")).distinct()
    rows = postings.select("id", "n", "shingle").join(named, "id").where("shingle <> shared")
    rows = rows.select(F.xxhash64(F.least("shingle", "shared"), F.greatest("shingle", "shared")).alias("region"), "id", "n").distinct()
    return _with_components(rows, components)


def _with_components(rows: DataFrame, components: DataFrame) -> DataFrame:
    linked = components.withColumnRenamed("component", "_c")
    known = rows.join(F.broadcast(linked) if components.count() <= BROADCAST_IDS else linked, "id", "left")
    return known.select(*rows.columns, F.coalesce("_c", "id").alias("component"))


def _candidates(lists: DataFrame, components: DataFrame, all_postings) -> DataFrame:
    """(region, id, component, earlier, side): regions in which every linked pair of different components with a heavy set meets.

    ``all_postings`` gives the postings of some ids, those of shingles without a list and the one more included.
    """
    lists = lists.select(F.col("shingle").alias("region"), "id", "n")
    measured = _measured(_with_components(lists, components))
    crowded = measured.where("not fits")
    if not crowded.isEmpty():
        postings = all_postings(cut(crowded.select("id").distinct()))
        measured = measured.where("fits").unionByName(_measured(_by_two(crowded, postings, components)))
    return _dealt(_with_earlier(measured))


def _of_one_id(linkable: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links of the nodes of an id that has several texts."""
    several = linkable.groupBy("id").agg(F.min("one").alias("low"), F.max("one").alias("high")).where("low < high").select("id")
    named = linkable.join(several, "id").join(nodes.select("one", "two", "n", F.col("id").alias("node")), ["one", "two", "n"])
    return named.select(F.least("id", "node").alias("a"), F.greatest("id", "node").alias("b")).where("a < b").distinct()


def joined(docs: DataFrame, id_: str = "doc_id", text: str = "text", size: int = WORDS, share: int = SHARE) -> DataFrame:
    """(id, n_shingles, component_id) for every row: the smallest id that links reach."""
    docs = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
    described = stored(_described(docs, size), "described")
    linkable = described.where("n > 0 and id is not null")
    nodes = stored(linkable.groupBy("one", "two", "n").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch")), "nodes")
    own = _of(docs, cut(nodes.select("id").distinct()), nodes.count())
    counts = _cell_counts(own, size)
    small = cut(nodes.where(f"n <= {MOST_LIGHT}").select("id").distinct())
    few = _of(docs, small, small.count())
    by_size = _postings(few, size, share, counts).groupBy("n").agg(F.sum("weight").alias("w"), F.sum((F.col("rank") == 0).cast("int")).alias("sets")).where(f"n <= {MOST_LIGHT}").collect()
    boundary = boundary_of_least_cost({r["n"]: r["sets"] for r in by_size}, {r["n"]: r["w"] for r in by_size}, share)
    links = light_links(few, boundary, size, share) if boundary else None
    postings = _postings(own, size, share, counts).where(f"100 * n >= {share * (boundary + 1)} and rank < n + 1 + floor(-{share} * n / 100)")
    lists = stored(_shared(postings, share, boundary), "lists")
    heavy = verified(_trees(_with_sketches(_first_lists(lists), nodes), share, boundary), docs, size, share)
    links = heavy.union(_of_one_id(linkable, nodes)).union(links) if links is not None else heavy.union(_of_one_id(linkable, nodes))
    components = cut(connected(links))
    regions = _candidates(lists, components, lambda ids: _postings(_of(docs, ids, ids.count()), size, share, counts))
    more = verified(_across(_with_sketches(regions, nodes), share, boundary), docs, size, share)
    components = connected(components.select(F.col("component").alias("a"), F.col("id").alias("b")).union(more))
    known = nodes.select("one", "two", "n", "id").join(components, "id", "left").groupBy("one", "two", "n").agg(F.min(F.coalesce("component", "id")).alias("component"))
    rows = described.select("id", "n", "one", "two").alias("r").join(known.alias("k"), ["one", "two", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("r.id").isNotNull(), F.col("component")).otherwise(F.col("r.id"))
    return rows.select(F.col("r.id").alias("id"), F.col("n").alias("n_shingles"), component.alias("component_id"))


def op12_size_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of at least 80 percent."""
    return joined(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def components_sql(share: int, more: str = "") -> str:
    """SQL for the components of ``documents`` under links of so many percent; equal ids are one document."""
    return rf"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS s FROM dw WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= {share} * (a.n + b.n - c)),
ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reached r JOIN ways w ON w.x = r.y),
least_of AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id{more}
FROM (SELECT doc_id FROM documents) LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON x = doc_id
"""


OP12_SQL = components_sql(SHARE)
#: The SQL of the other operator that links by shingles, which also says what is kept.
OP2_SQL = components_sql(75, ", doc_id = least(doc_id, coalesce(y, doc_id)) AS kept")
