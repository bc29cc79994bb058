"""MinHash near-duplicates by an LSH forest.

A document is the set of its distinct shingles of ``words`` words (A-Z lower-cased). Its signature of ``VALUES``
MinHash values makes ``TREES`` sorted orders: each tree sorts by its own run of values, and documents with a longest common prefix
in a tree are its candidates. Depth is adapted by region: a region of equal prefixes is read at the
shallowest depth at which its candidate pairs are no more than a fixed number for each of its members; regions above it go
one level deeper (1, 2, 4, 8, 16 values).

Equal sets are one node. Two rounds keep a large group of near copies from being compared pair by pair: the first
verifies every node's most similar candidate of smaller id and joins what is linked; in the second a region counts
only pairs of different components, and all of these are candidates, verified inside the region, so that no
pair is a row. The first round only joins what it can, and compares what remains too large at the last level in
blocks; the second goes no deeper than ``DEEPEST`` values, and the members of regions that are still too large are compared
by a prefix filter, which misses no pair: two sets as similar as a link share one of the rarest shingles of each, so
many as the share leaves out and one more. Every such shingle is a region of its own, and what remains too large there is compared in
blocks, all against all. Candidates whose signatures agree far less (four standard deviations) than
those of linked documents are left out; all others are verified on their full sets. Links are
connected by ``connected``.

At the least similarity of a link, 0.75, a pair shares a first value in one of 16 trees with probability
1 - 2e-10, the first two with 1 - 2e-6, the first four with 0.998; no pair depends on more.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and is its own
component; a text with fewer words than a shingle has its word sequence as its only shingle; rows of equal id are
one document for linking; a null id is linked with nothing, has a null component and is kept. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import LINKS_PER_TASK, connected, cut, gathered, table
from natalis.llm.textarrays import LOWER, flat, mixed, slices, span_hashes, window_hashes, words

WORDS = 5
SHARE = 75
TREES, DEPTHS = 16, (1, 2, 4, 8, 16)
VALUES = TREES * DEPTHS[-1]
#: Values that the second round reads, at most.
DEEPEST = 4
#: Cells in which shingles are counted to tell rare ones: the order is one for all sets, however full the cells.
CELL_BITS = 20
#: Members that share a cell of pairs to verify, about.
CELL = 256
#: Trees that the first round reads.
TREES_FIRST = 8
#: Candidate pairs for each member of a region, in the first and in the second round.
PAIRS_FIRST, PAIRS_SECOND = 64, 256
#: Members of a region that share a block; partners of a document that are verified together.
BLOCK, PARTNERS = 1024, 64
#: Ids up to which their documents are found by a broadcast (some 32 MB); beyond, by a shuffle.
BROADCAST_IDS = 2_000_000
#: Documents, and pairs to verify, whose rows a task reads, about, where they are joined and counted.
DOCS_PER_TASK, PAIRS_PER_TASK = 4096, 16_384
SLICE = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(batch: pa.RecordBatch, text: str, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    data, offsets = flat(batch.column(text))
    data = LOWER[data]
    starts, ends, firsts = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    grams = window_hashes(hashes, size)
    for a, b in zip(firsts, firsts[1:], strict=False):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            # fewer words: the sequence as a whole, told apart from shingles by its length
            yield mixed(np.array([window_hashes(hashes[a:b], b - a)[0] ^ np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * _GOLDEN)
    return (seeds[:VALUES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[VALUES:] >> np.uint64(32)).astype(np.uint32)


def signature(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(out, (short[None, at : at + 1024] * factors[:, None] + terms[:, None]).min(1), out=out)
    return out


def prefix_keys(signatures: np.ndarray) -> np.ndarray:
    """For every row, tree and depth a 64-bit key of the tree and its prefix."""
    trees = signatures.reshape(len(signatures), TREES, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64) * _GOLDEN, trees.shape[:2])
    out = []
    for k in range(DEPTHS[-1]):
        key = mixed((key ^ trees[:, :, k]) * _GOLDEN + np.uint64(k + 1))
        if k + 1 in DEPTHS:
            out.append(key)
    return np.stack(out, 2)


def marks(signatures: np.ndarray) -> np.ndarray:
    """Two bits of every value, four values a byte."""
    low = (mixed(signatures.astype(np.uint64)) & np.uint64(3)).astype(np.uint8)
    return low[:, ::4] << 6 | low[:, 1::4] << 4 | low[:, 2::4] << 2 | low[:, 3::4]


#: How many of the four pairs of bits of a byte are zero, for the exclusive or of two bytes of marks.
_EQUAL = np.array([sum((x >> k & 3) == 0 for k in (0, 2, 4, 6)) for x in range(256)], np.uint8)


def least_equal(share: int) -> int:
    """Equal marks of two signatures below which a similarity of ``share`` percent is ruled out (four standard deviations)."""
    p = share / 100 + (1 - share / 100) / 4
    return int(VALUES * p - 4 * (VALUES * p * (1 - p)) ** 0.5)


def describe(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, one, two, keys, marks): set size, 128 bits that tell sets apart, and the signature's prefix keys and marks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, terms = _coefficients()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = list(shingle_sets(part, "text", size))
                signatures = np.stack([signature(s, factors, terms) for s in sets])
                keys = prefix_keys(signatures).reshape(len(sets), -1).astype(np.int64)
                one = [int(mixed(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                two = [int(mixed(s * _GOLDEN).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(list(keys), pa.list_(pa.int64())), pa.array([m.tobytes() for m in marks(signatures)], pa.binary())],
                    names=["id", "n", "one", "two", "keys", "marks"],
                )

    return docs.mapInArrow(rows, "id long, n long, one long, two long, keys array<long>, marks binary")


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        last = int(np.searchsorted(values, values[-1], "left"))
        if last == 0 and rest and rest[-1].column(key)[-1].as_py() == values[0]:
            rest.append(batch)
            continue
        if last == 0:
            if rest:
                yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            yield pa.Table.from_batches([*rest, batch.slice(0, last)])
            rest = [batch.slice(last)]
    if rest:
        yield pa.Table.from_batches(rest)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _EQUAL[a ^ b].sum(1, dtype=np.int32)


def _pairs(group: pa.Table, share: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers i, j of one region and different components, and how many marks agree, for all pairs that may be linked."""
    region, component, n = (group.column(k).to_numpy() for k in ("region", "component", "n"))
    seen = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(len(region), -1)
    least = least_equal(share)
    first = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
    sizes = np.diff(np.append(first, len(region)))
    small = np.repeat(sizes <= 2 * PAIRS_SECOND, sizes)
    i = np.flatnonzero(small)
    for step in range(1, int(sizes[sizes <= 2 * PAIRS_SECOND].max(initial=0))):
        i = i[i + step < len(region)]
        i = i[region[i + step] == region[i]]
        yield from _screened(i, i + step, component, n, seen, share, least)
    for at, size in zip(first, sizes, strict=True):
        if size > 2 * PAIRS_SECOND:
            own = np.arange(at, at + size)
            values, counts = np.unique(component[own], return_counts=True)
            others = own[component[own] != values[counts.argmax()]]
            rest = own[component[own] == values[counts.argmax()]]
            for k, row in enumerate(others):
                partners = np.concatenate([others[k + 1 :], rest])
                yield from _screened(np.full(len(partners), row), partners, component, n, seen, share, least)


def _screened(i, j, component, n, seen, share, least):
    keep = (component[i] != component[j]) & (100 * np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j]))
    i, j = i[keep], j[keep]
    if len(i):
        agree = _agreement(seen[i], seen[j])
        keep = agree >= least
        if keep.any():
            yield i[keep], j[keep], agree[keep]


def _sorted_map(rows: DataFrame, key: str, function, fields: str, *more: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key, *more).mapInArrow(function, fields)


def _measured(rows: DataFrame, per_member: int, docs: int) -> DataFrame:
    """The rows (region, id, component, ...) of regions of several components, with size, largest component, and whether the pairs fit; of ``docs`` documents."""
    parts = gathered(rows.groupBy("region", "component").agg(F.count("*").alias("c")), docs, DOCS_PER_TASK)
    stats = parts.groupBy("region").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max_by("component", F.struct("c", "component")).alias("major"), F.count("*").alias("parts"))
    stats = stats.where("parts > 1").select("region", "m", "major", ((F.col("m") * F.col("m") - F.col("squares")) <= 2 * per_member * F.col("m")).alias("fits"))
    return cut(gathered(rows.join(stats, "region").select(*rows.columns, "m", "major", "fits"), docs, DOCS_PER_TASK))


def _fitting(rows: DataFrame) -> DataFrame:
    """(region, id, component) of measured rows that fit: members of the largest component are dealt to blocks, all others go to each of them."""
    fitting = rows.where("fits")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = F.when(F.col("component") == F.col("major"), F.array(F.pmod(F.xxhash64("id"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1))
    fitting = fitting.select("id", "component", "region", blocks.alias("blocks"), F.explode(dealt).alias("block"))
    return fitting.select(F.when(F.col("blocks") > 1, F.xxhash64("region", "block")).otherwise(F.col("region")).alias("region"), "id", "component")


def _blocks(left: DataFrame, per_member: int, leaders: bool) -> DataFrame:
    """(region, id, component) of regions (region, id, component, m) cut into blocks: with ``leaders`` each has the
    region's first member too, else every two blocks share a region of their own.
    """
    many = F.ceil(F.col("m") / per_member).cast("int")
    left = left.withColumn("blocks", many).withColumn("block", F.pmod(F.xxhash64("id"), many).cast("int"))
    if leaders:
        first = left.groupBy("region", "blocks").agg(F.min(F.struct("id", "component")).alias("f")).select("region", F.col("f.id").alias("id"), F.col("f.component").alias("component"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        left = left.select("region", "id", "component", "block").union(first)
    else:
        cell = F.expr("transform(sequence(0, blocks - 1), o -> least(block, o) * blocks + greatest(block, o))")
        left = left.select("region", "id", "component", F.explode(cell).alias("block"))
    return left.select(F.xxhash64("region", "block").alias("region"), "id", "component")


def _marked(regions: DataFrame, nodes: DataFrame, docs: int) -> DataFrame:
    marked = gathered(regions.distinct(), docs, DOCS_PER_TASK).join(nodes.select("id", "n", "marks"), "id")
    return gathered(marked.select("id", "region", "component", "n", "marks"), docs, DOCS_PER_TASK)


def _regions(nodes: DataFrame, docs: int, trees: int, per_member: int, depths: tuple[int, ...] = DEPTHS) -> tuple[DataFrame, DataFrame]:
    """(region, id, component) of all regions whose pairs fit at one of the depths, and (region, id, component, m) of those that never do.

    Nodes are (id, component, n, keys, marks) of ``docs`` documents. A region of one component is left out.
    """
    out = None
    left = nodes.select("id", "component", F.posexplode(F.expr(f"transform(sequence(0, {trees - 1}), t -> slice(keys, t * {len(DEPTHS)} + 1, {len(DEPTHS)}))")).alias("tree", "prefixes"))
    for level in range(len(depths)):
        rows = left.select("id", "component", "prefixes", F.col("prefixes")[level].alias("region"))
        rows = _measured(rows, per_member, docs)
        fitting = _fitting(rows)
        out = fitting if out is None else out.union(fitting)
        left = rows.where("not fits").select("id", "component", "prefixes", "region", "m")
    return out, left.select("region", "id", "component", "m")


def _rarest(ids: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """(id, region): of every document's shingles the rarest that any set as similar as ``share`` percent must share one of.

    Rare by counts in cells of hashes, equal counts by hash, so that all sets have the same order. Texts are shingled in the
    step that counts and again in the one that ranks: a task of two Python steps would run, and keep, two Python workers.
    """
    wanted = _wanted(ids, ids.count(), docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for values in shingle_sets(part, "text", size):
                    total[(values >> np.uint64(64 - CELL_BITS)).astype(np.int64)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    found = wanted.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for id_, values in zip(part.column("id").to_pylist(), shingle_sets(part, "text", size), strict=True):
                    order = np.lexsort((values, counts[(values >> np.uint64(64 - CELL_BITS)).astype(np.int64)]))
                    kept = values[order[: len(values) - -(-share * len(values) // 100) + 1]].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), id_, np.int64)), pa.array(kept)], names=["id", "region"])

    return wanted.mapInArrow(first, "id long, region long")


def _filtered(crowded: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """The rows (id, region, component, n, marks) of cells that together have every pair of crowded members that may be linked.

    Members meet in regions of their rarest shingles, and pairs that may be linked name a cell of two blocks of ids, so that
    no pair is a row and a member's set is carried once for each block that it has partners in and not for each shingle.
    """
    crowded = cut(crowded.select("id", "component").distinct().join(nodes.select("id", "n", "marks"), "id"))
    members = crowded.count()
    known = F.broadcast(crowded) if members <= BROADCAST_IDS // 8 else crowded
    rows = _measured(_rarest(crowded.select("id"), docs, size, share).join(known, "id").select("region", "id", "component"), PAIRS_SECOND, members)
    regions = _fitting(rows).union(_blocks(rows.where("not fits"), PAIRS_SECOND, False))
    regions = regions.select("region", "id").join(known, "id").select("id", "region", "component", "n", "marks")
    many = np.uint64(max(1, -(-members // CELL)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "region"):
            ids = group.column("id").to_numpy()
            block = mixed(ids.astype(np.uint64) * _GOLDEN) % many
            for i, j, _ in _pairs(group, share):
                cell = mixed((np.minimum(block[i], block[j]) * many + np.maximum(block[i], block[j]) + np.uint64(1)) * _GOLDEN).astype(np.int64)
                members = np.unique(np.stack([np.concatenate([cell, cell]), np.concatenate([ids[i], ids[j]])], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(members[:, 0]), pa.array(members[:, 1])], names=["region", "id"])

    found = _sorted_map(regions, "region", cells, "region long, id long").distinct()
    return found.join(known, "id").select("id", "region", "component", "n", "marks")


def _nearest(regions: DataFrame, docs: int, share: int) -> DataFrame:
    """(a, b): every node's most similar candidate of those with smaller ids, which makes a tree of what is linked."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "region"):
            ids = group.column("id").to_numpy()
            most, partner = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int64)
            for i, j, agree in _pairs(group, share):
                i, j = np.where(ids[i] > ids[j], i, j), np.where(ids[i] > ids[j], j, i)
                # ascending, so that of several pairs of one i the best is written last
                order = np.argsort(agree, kind="stable")
                i, j, agree = i[order], j[order], agree[order]
                better = agree > most[i]
                most[i[better]], partner[i[better]] = agree[better], ids[j[better]]
            some = most > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(partner[some]), pa.array(most[some])], names=["a", "b", "agree"])

    found = _sorted_map(regions, "region", best, "a long, b long, agree int")
    found = gathered(found.groupBy("a").agg(F.max_by("b", F.struct("agree", -F.col("b"))).alias("b")), docs, DOCS_PER_TASK)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(regions: DataFrame, share: int) -> DataFrame:
    """The rows of regions that have a candidate of another component in their region."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "region"):
            found = np.zeros(group.num_rows, bool)
            for i, j, _ in _pairs(group, share):
                found[i] = found[j] = True
            yield from group.filter(pa.array(found)).to_batches()

    return _sorted_map(regions, "region", some, "id long, region long, component long, n long, marks binary")


def _overlaps(own: np.ndarray, partners: np.ndarray, values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """How many values each partner's set has in common with one's own; flags has a place for each value, all false."""
    flags[own] = True
    lengths = sizes[partners]
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1])) + np.repeat(starts[partners] - (ends - lengths), lengths)
    both = np.add.reduceat(flags[values[at]], ends - lengths, dtype=np.int64)
    flags[own] = False
    return both


def _links_within(regions: DataFrame, share: int) -> DataFrame:
    """(a, b): links between components inside each region, verified on the sets that its rows carry; enough to join what is linked."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table_ in _groups(batches, "region"):
            region = table_.column("region").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, region[1:] != region[:-1])), len(region))
            for low, high in zip(edges, edges[1:], strict=False):
                found = _linked(table_.slice(int(low), int(high - low)).combine_chunks(), share)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([min(f) for f in found], pa.int64()), pa.array([max(f) for f in found], pa.int64())], names=["a", "b"])

    return _sorted_map(regions, "region", links, "a long, b long").distinct()


def _linked(group: pa.Table, share: int) -> list[tuple[int, int]]:
    ids = group.column("id").to_numpy()
    pairs = list(_pairs(group, share))
    if not pairs:
        return []
    i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    _, parts = np.unique(group.column("component").to_numpy(), return_inverse=True)
    # the row with more candidates first: it is compared with all of them at once
    often = np.bincount(np.concatenate([i, j]), minlength=len(ids))
    i, j = np.where(often[i] >= often[j], i, j), np.where(often[i] >= often[j], j, i)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    names, values = np.unique(np.concatenate(sets), return_inverse=True)
    flags = np.zeros(len(names), bool)
    found = []
    edges = np.append(np.flatnonzero(np.append(True, i[1:] != i[:-1])), len(i))
    for low, high in zip(edges, edges[1:], strict=False):
        row, partners = int(i[low]), j[low:high]
        partners = partners[parts[partners] != parts[row]]
        if not len(partners):
            continue
        both = _overlaps(values[starts[row] : starts[row] + sizes[row]], partners, values, starts, sizes, flags)
        for other in partners[100 * both >= share * (sizes[row] + sizes[partners] - both)]:
            if parts[other] != parts[row]:
                found.append((int(ids[row]), int(ids[other])))
                parts[parts == parts[other]] = parts[row]
    return found


def _with_sets(rows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The rows with the shingle sets of their ids; only the wanted documents are shingled again."""
    ids = cut(rows.select("id").distinct())
    return rows.join(_sets(ids, ids.count(), docs, size), "id")


def _wanted(ids: DataFrame, count: int, docs: DataFrame) -> DataFrame:
    """The documents with so many ids."""
    return docs.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, "id", "left_semi")


def _sets(ids: DataFrame, count: int, docs: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of the documents with so many ids."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in shingle_sets(part, "text", size)], pa.binary())], names=["id", "shingles"])

    return _wanted(ids, count, docs).mapInArrow(sets, "id long, shingles binary")


def verified(pairs: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Partners of a document are dealt to groups of about ``PARTNERS``, each with a copy of the document's set.
    """
    pairs = cut(pairs)
    number = pairs.count()
    pairs = gathered(pairs, number, PAIRS_PER_TASK)
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PARTNERS)).alias("part"))
    dealt = gathered(dealt.select(F.xxhash64("a", "part").alias("group"), "a", "b"), number, PAIRS_PER_TASK)
    members = dealt.select("group", "a", F.lit(False).alias("partner"), F.col("a").alias("id")).distinct()
    members = gathered(members, number, PAIRS_PER_TASK).union(dealt.select("group", "a", F.lit(True), "b"))
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[int, int, list[np.ndarray]] = (0, 0, [])
        for batch in batches:
            found = []
            for group, a, partner, id_, shingles in zip(*(batch.column(k).to_pylist() for k in ("group", "a", "partner", "id", "shingles")), strict=True):
                values = np.frombuffer(shingles, np.uint64)
                if not partner:
                    own = (group, a, [values, *(own[2] if own[:2] == (group, a) else [])])
                    continue
                for mine in own[2]:
                    both = len(np.intersect1d(mine, values, assume_unique=True))
                    if 100 * both >= share * (len(mine) + len(values) - both):
                        found.append((a, id_))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    rows = _with_sets(members, docs, size)
    return _sorted_map(rows, "group", compare, "a long, b long", "a", "partner").distinct()


def _uphill(links: DataFrame) -> DataFrame:
    """(id, component): every node's ancestor by links (a, b) that lead each b to one smaller a, up to 32 steps up.

    Nodes further down get an ancestor of their own; the second round and ``connected`` join them.
    """
    up = cut(links.select(F.col("b").alias("id"), F.col("a").alias("component")))
    number = up.count()
    up = gathered(up, number, LINKS_PER_TASK)
    for _ in range(5):
        above = up.select(F.col("id").alias("component"), F.col("component").alias("next"))
        up = gathered(up.join(above, "component", "left").select("id", F.coalesce("next", "component").alias("component")), number, LINKS_PER_TASK)
    return up


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", size: int = WORDS, share: int = SHARE) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: the smallest id that links reach, and whether it is the row's own."""
    docs = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
    described = cut(describe(docs, size))
    linkable = described.where("n > 0 and id is not null")
    count = described.count()
    nodes = linkable.groupBy("one", "two", "n").agg(F.min("id").alias("id"), F.first("keys").alias("keys"), F.first("marks").alias("marks"))
    nodes = cut(gathered(nodes, count, DOCS_PER_TASK))
    alone = nodes.withColumn("component", F.col("id")).select("id", "component", "n", "keys", "marks")
    regions, left = _regions(alone, count, TREES_FIRST, PAIRS_FIRST)
    links = verified(_nearest(_marked(regions.union(_blocks(left, PAIRS_FIRST, True)), alone, count), count, share), docs, size, share)
    stars = cut(_uphill(links))
    joined = nodes.join(stars, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "n", "keys", "marks")
    regions, crowded = _regions(joined, count, TREES, PAIRS_SECOND, tuple(d for d in DEPTHS if d <= DEEPEST))
    narrowed = _candidates(_marked(regions, joined, count), share)
    if not crowded.isEmpty():
        narrowed = narrowed.unionByName(_filtered(crowded, joined, docs, size, share))
    narrowed = cut(narrowed)
    more = _links_within(_with_sets(narrowed, docs, size), share)
    components = connected(stars.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    known = nodes.select("one", "two", "n", "id").join(components, "id", "left").select("one", "two", "n", F.coalesce("component", "id").alias("component"))
    rows = described.select("id", "n", "one", "two").alias("r").join(known.alias("k"), ["one", "two", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("r.id").isNotNull(), F.col("component")).otherwise(F.col("r.id"))
    return rows.select(F.col("r.id").alias("id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("r.id") == component, F.lit(True)).alias("kept"))


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
