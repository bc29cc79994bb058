"""Suffix-array deduplication: repeated byte strings by column-wise construction over many documents.

A byte goes where a ``size``-byte string that covers it also starts in a document with a smaller id.

Whole documents can't be inserted a column at a time across a cluster: the longest would make as many
rounds as it has bytes. So every document is first cut, by content, into overlapping segments of at most
``2 * size - gram`` bytes: each string of ``size`` bytes belongs to the segment of its anchor, the rightmost of
its smallest gram hashes. Equal strings have equal anchors, so segments with equal anchors meet in a
bucket, wherever they come from. Two equal strings also agree in half of what a string has besides its anchor, before the
anchor or behind it: segments of which a merged count-min sketch shows neither half with the anchor to occur twice are left out first.

In a bucket the distinct segments are the collection. Each round inserts one more symbol of every segment, from
its end, and updates the collection's Burrows-Wheeler transform and the suffixes in order: the
transform's symbols in stable order are the next first column, so a round reads the
columns of the last one from sequential files and writes the next ones. Common prefixes of neighbours
are then read off, up to ``size`` symbols; neighbours with that much in common are one class, and a string goes if its
class has a smaller document.

Defined results: a null text is empty; texts under ``size`` bytes lose nothing; equal texts of different
ids lose everything but for the smallest id; rows of equal id count as one document for each other and
lose nothing to each other; ids must be integers (a null id counts as the largest). Only id and text are read.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import table, text_bytes
from natalis.llm.sketch import REPLY, SENT, Layout, by_chunk, estimated, merge, send
from natalis.llm.textarrays import BASE, BASE_TWO, PIECE, covered, flat, mixed, span_hashes, window_hashes

SIZE, GRAM = 50, 16
#: Bytes of text for each anchor, about: two anchors for a window of grams.
BYTES_PER_ANCHOR = 17
#: Buckets for each chunk of documents, so that a bucket's columns stay small.
BUCKETS_PER_CHUNK = 4
SEGMENTS = "chunk int, bucket int, n int, sizes binary, ids binary, anchors binary, texts binary, raw long"
ANSWERS = "chunk int, shard long, bits binary"
_LAST = np.iinfo(np.int64).max


def _windows_min(values: np.ndarray, size: int) -> np.ndarray:
    step = 1
    while 2 * step <= size:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = size - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of all texts: text number, first string start, end of the last string, the anchor's start and its hash.

    Starts and ends are bytes of data. The strings of a segment start at consecutive bytes.
    """
    found: list[tuple[np.ndarray, ...]] = []
    lengths = np.diff(offsets)
    span = size - gram + 1
    at = 0
    while at < len(lengths):
        # some texts of together a piece, or a piece of one longer text
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        low, end = int(offsets[at]), int(offsets[to])
        for begin in range(low, max(low + 1, end), PIECE):
            stop = min(end, begin + PIECE + size - 1)
            if stop - begin < size:
                continue
            part = data[begin:stop].astype(np.uint64)
            hashes = window_hashes(part, gram)
            keys = hashes & ~np.uint64(0xFFFFF) | np.arange(len(hashes) - 1, -1, -1, dtype=np.uint64)
            place = len(hashes) - 1 - (_windows_min(keys, span) & np.uint64(0xFFFFF)).astype(np.int64)
            starts = begin + np.arange(len(place))
            text = np.searchsorted(offsets, starts, "right") - 1
            inside = starts + size <= offsets[text + 1]
            starts, text, place = starts[inside], text[inside], place[inside]
            first = np.ones(len(starts), bool)
            first[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (starts[1:] != starts[:-1] + 1)
            edges = np.flatnonzero(first)
            lasts = np.append(edges[1:], len(starts)) - 1
            found.append((text[edges], starts[edges], starts[lasts] + size, begin + place[edges], mixed(hashes[place[edges]]) if len(edges) else np.zeros(0, np.uint64)))
        at = to
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def halves(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spots: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every segment's anchor with the bytes before it, and of that with those behind it, and their segments' numbers.

    So many bytes of either side are taken that every string around the anchor has one of both; a segment
    may lack a side, and then none of its strings has it.
    """
    half = (size - gram + 1) // 2
    before, behind = np.flatnonzero(spots - half >= starts), np.flatnonzero(spots + gram + half <= ends)
    hashes = [span_hashes(data, spots[before] - half, spots[before] + gram), span_hashes(data, spots[behind], spots[behind] + gram + half)]
    return np.concatenate(hashes), np.concatenate([before, behind])


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after another."""
    ends = np.cumsum(sizes)
    index = np.arange(int(ends[-1]) if len(ends) else 0)
    return data[index + np.repeat(starts - (ends - sizes), sizes)]


def distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every span the number of its content, and for every content the span of the smallest owner.

    Contents are told apart by 128 bits of hash and their length.
    """
    sums = [span_hashes(data, starts, starts + sizes, base) for base in (BASE, BASE_TWO)]
    order = np.lexsort((owners, sums[1], sums[0], sizes))
    new = np.ones(len(order), bool)
    new[1:] = (sizes[order[1:]] != sizes[order[:-1]]) | (sums[0][order[1:]] != sums[0][order[:-1]]) | (sums[1][order[1:]] != sums[1][order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


class Columns:
    """The transform and the suffixes of a collection, in two sequential files that change places every round."""

    def __init__(self, folder: str | None = None):
        self._now, self._next = tempfile.TemporaryFile(dir=folder), tempfile.TemporaryFile(dir=folder)
        self._n = 0

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        self._now.seek(0)
        transform = np.frombuffer(self._now.read(self._n), np.uint8)
        return transform, np.frombuffer(self._now.read(4 * self._n), np.int32)

    def write(self, transform: np.ndarray, suffixes: np.ndarray) -> None:
        self._next.seek(0)
        self._next.write(transform.tobytes())
        self._next.write(suffixes.tobytes())
        self._n = len(transform)
        self._now, self._next = self._next, self._now

    def close(self) -> None:
        self._now.close()
        self._next.close()


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a collection in order, a shorter one before those it begins.

    text holds the strings one after another, ends where they end. After round j the files have the
    transform of all suffixes of up to j symbols; the next round takes one more symbol of every string.
    """
    if not len(ends):
        return np.zeros(0, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    # a 0 stands before every string (there the transform has no symbol to insert), real symbols are 1 to 256
    before = np.zeros(len(text) + 1, np.uint16)
    before[1:] = text
    before[1:] += 1
    used = np.unique(text)
    rank = np.zeros(257, np.uint8)
    if len(used) > 255:
        raise ValueError("a bucket with all 256 byte values")  # UTF-8 has no such texts
    rank[used.astype(np.int64) + 1] = np.arange(1, len(used) + 1)
    before = rank[before]
    at_start = np.zeros(len(text) + 1, bool)
    at_start[starts] = True
    symbol = np.where(at_start, np.uint8(0), before)  # the symbol before each place; 0 at starts of strings
    last = np.where(ends > starts, before[ends], np.uint8(0))
    columns = Columns()
    try:
        # round 0: the empty suffixes, in the order of the strings
        empty = ends.astype(np.int32)
        columns.write(last, empty)
        for _ in range(int((ends - starts).max())):
            transform, suffixes = columns.read()
            done = len(transform) - np.count_nonzero(transform)
            places = suffixes[np.argsort(transform, kind="stable")[done:]] - np.int32(1)
            columns.write(np.concatenate([last, symbol[places]]), np.concatenate([empty, places]))
        return columns.read()[1][len(ends) :]
    finally:
        columns.close()


def covered_before(text: np.ndarray, sizes: np.ndarray, owners: np.ndarray, size: int) -> np.ndarray:
    """For every ``size``-byte string of the segments (in order), whether one equal to it starts in a segment of a smaller owner."""
    ends = np.cumsum(sizes)
    order = suffix_order(text, ends)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    order = order[ends[segment[order]] - order >= size]  # the suffixes that begin with a whole string
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    same = np.ones(len(order), bool)
    same[:1] = False
    for shift in range(0, size, 8):
        word = np.zeros(len(order), np.uint64)
        for k in range(shift, min(size, shift + 8)):
            word = word << np.uint64(8) | padded[order + k]
        same[1:] &= word[1:] == word[:-1]
    at = np.flatnonzero(~same)
    mine = owners[segment[order]]
    least = np.repeat(np.minimum.reduceat(mine, at), np.diff(np.append(at, len(order)))) if len(at) else mine
    out = np.zeros(len(text), bool)
    out[order] = least < mine
    left = np.repeat(ends, sizes) - np.arange(len(text))
    return out[left >= size]


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def remove_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, kept, spans) for every row: what stays, as binary, and the removed runs [start, end) in bytes."""
    total = text_bytes(docs, text)
    layout = Layout(total, 2 * (total // BYTES_PER_ANCHOR))
    buckets = layout.chunks * BUCKETS_PER_CHUNK
    base = by_chunk(docs, id_, text, layout.chunks)

    def cut_up(group: pa.Table) -> tuple[np.ndarray, ...]:
        data, offsets = flat(group.column("text"))
        return data, offsets, *anchors(data, offsets, size, gram)

    def sketch_chunk(group: pa.Table) -> pa.Table:
        data, _, _, starts, ends, spots, _ = cut_up(group)
        return send(group.column("chunk")[0].as_py(), halves(data, starts, ends, spots, size, gram)[0], layout)

    def segments(group: pa.Table, reply: pa.Table) -> tuple[np.ndarray, ...]:
        """The segments with a repeated half: data, offsets, texts, starts, sizes, owners, bucket; their content number and one span for each."""
        data, offsets, text_no, starts, ends, spots, hashes = cut_up(group)
        sides, of = halves(data, starts, ends, spots, size, gram)
        again = estimated(sides, layout, {s: b for s, b, k in zip(reply.column("shard").to_pylist(), reply.column("bits").to_pylist(), reply.column("kind").to_pylist(), strict=True) if k == 1})
        keep = np.zeros(len(starts), bool)
        keep[of[again]] = True
        text_no, starts, sizes, hashes = text_no[keep], starts[keep], (ends - starts)[keep], hashes[keep]
        owners = group.column("id").combine_chunks().cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)[text_no]
        number, chosen = distinct(data, starts, sizes, owners)
        place = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(place[chosen], kind="stable")  # contents by bucket
        number = np.argsort(order)[number] if len(order) else number
        return data, offsets, hashes, starts, sizes, owners, place, number, chosen[order]

    def send_segments(group: pa.Table, reply: pa.Table) -> pa.Table:
        data, _, hashes, starts, sizes, owners, place, _, chosen = segments(group, reply)
        edges = np.searchsorted(place[chosen], np.arange(buckets + 1))
        out = {k: [] for k in ("chunk", "bucket", "n", "sizes", "ids", "anchors", "texts", "raw")}
        for k in np.flatnonzero(np.diff(edges)):
            own = chosen[edges[k] : edges[k + 1]]
            raw = gather(data, starts[own], sizes[own]).tobytes()
            values = (group.column("chunk")[0].as_py(), int(k), len(own), sizes[own].astype(np.uint8).tobytes(), owners[own].tobytes(), hashes[own].tobytes(), _codec().compress(raw, asbytes=True), len(raw))
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.table(out, pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("sizes", pa.binary()), ("ids", pa.binary()), ("anchors", pa.binary()), ("texts", pa.binary()), ("raw", pa.int64())]))

    def compare(group: pa.Table) -> pa.Table:
        sizes = np.concatenate([np.frombuffer(b, np.uint8) for b in group.column("sizes").to_pylist()]).astype(np.int64)
        owners = np.concatenate([np.frombuffer(b, np.int64) for b in group.column("ids").to_pylist()])
        texts = np.concatenate([np.frombuffer(_codec().decompress(b, n, asbytes=True), np.uint8) for b, n in zip(group.column("texts").to_pylist(), group.column("raw").to_pylist(), strict=True)])
        starts = np.cumsum(sizes) - sizes
        number, chosen = distinct(texts, starts, sizes, owners)
        per = sizes[chosen] - size + 1
        # a content that is the only one of its anchor has no string that another content has
        hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in group.column("anchors").to_pylist()])[chosen]
        _, of, times = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = times[of] > 1
        some = chosen[shared]
        gone = np.zeros(int(per.sum()), bool)
        gone[np.repeat(shared, per)] = covered_before(gather(texts, starts[some], sizes[some]), sizes[some], owners[some], size)
        first = np.cumsum(per) - per
        # a content's bits for its smallest owner; all strings go where a smaller owner has the same content
        lengths = sizes - size + 1
        answer = gone[np.arange(int(lengths.sum())) + np.repeat(first[number] - (np.cumsum(lengths) - lengths), lengths)]
        answer |= np.repeat(owners > owners[chosen][number], lengths)
        row = np.repeat(np.arange(group.num_rows), group.column("n").to_numpy())
        stops = np.cumsum(np.bincount(row, lengths, minlength=group.num_rows).astype(np.int64))
        bits = [np.packbits(answer[a:b]).tobytes() for a, b in zip(np.concatenate([[0], stops[:-1]]), stops, strict=True)]
        return pa.table({"chunk": group.column("chunk"), "shard": group.column("bucket").cast(pa.int64()), "bits": pa.array(bits, pa.binary())})

    def cut_out(group: pa.Table, reply: pa.Table) -> pa.Table:
        data, offsets, _, starts, sizes, owners, place, number, chosen = segments(group, reply)
        back = {s: b for s, b, k in zip(reply.column("shard").to_pylist(), reply.column("bits").to_pylist(), reply.column("kind").to_pylist(), strict=True) if k == 2}
        per = sizes[chosen] - size + 1
        edges = np.searchsorted(place[chosen], np.arange(buckets + 1))
        answer = [np.unpackbits(np.frombuffer(back[int(k)], np.uint8), count=int(per[edges[k] : edges[k + 1]].sum())) for k in np.flatnonzero(np.diff(edges))]
        marked = np.zeros(len(data), bool)
        if answer:
            flags = np.concatenate(answer).astype(bool)
            first = np.cumsum(per) - per
            lengths = sizes - size + 1
            at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            gone = flags[at + np.repeat(first[number], lengths)] | np.repeat(owners > owners[chosen][number], lengths)
            marked[(at + np.repeat(starts, lengths))[gone]] = True
        gone = covered(marked, size, len(data))
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = gone & np.concatenate([[True], ~gone[:-1]])[: len(gone)] | gone & edge[:-1]
        finish = gone & (np.concatenate([~gone[1:], [True]])[: len(gone)] | edge[1:])
        begin, finish = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        of = np.searchsorted(begin, offsets)
        kept, spans = [], []
        for k, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
            kept.append(data[a:b][~gone[a:b]].tobytes())
            spans.append([{"start": int(s - a), "end": int(e - a)} for s, e in zip(begin[of[k] : of[k + 1]], finish[of[k] : of[k + 1]], strict=True)])
        run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": group.column("id"), "n_bytes": pa.array(np.diff(offsets)), "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, run)})

    id_type = base.schema["id"].dataType.simpleString()
    sent = base.groupBy("chunk").applyInArrow(sketch_chunk, SENT)
    first = sent.groupBy("shard").applyInArrow(merge, REPLY).withColumn("kind", F.lit(1))
    dealt = base.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(send_segments, SEGMENTS)
    second = dealt.groupBy("bucket").applyInArrow(compare, ANSWERS).withColumn("kind", F.lit(2))
    result = f"id {id_type}, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"
    return base.groupBy("chunk").cogroup(first.union(second).groupBy("chunk")).applyInArrow(cut_out, result)


def op6_suffix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that start in a document of a smaller id."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.col("n_bytes") - F.octet_length("kept")
    return found.select(F.col("id").alias("doc_id"), "n_bytes", gone.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
