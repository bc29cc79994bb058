"""Substring deduplication of word windows behind a count-min prefilter.

First pass: chunks of documents sketch the hashes of all windows of ``size`` words, and the merged sketches
overestimate how often each occurs (see ``sketch``). Second pass: only windows estimated to occur at least
twice are grouped exactly, by 128 bits of their word sequence. A window is repeated if it starts anywhere
else, in the same document or another; every word that a repeated window covers is removed.

A chunk sends an equal window once, with a mark if it had it twice, so that a passage that a third of all
documents share meets in one place no more often than there are chunks.

Defined results: a null or empty text has no words and keeps the empty text; a text of fewer words than a
window loses none; repeated rows are documents with equal windows and lose them; only id and text are
read. Kept words are joined by one blank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import table, text_bytes
from natalis.llm.sketch import REPLY, SENT, SHARD_VALUES, Layout, by_chunk, estimated, merge, replies, send
from natalis.llm.textarrays import BASE, BASE_TWO, LOWER, covered, flat, span_hashes, whole, window_hashes, words

SIZE = 35
#: Bytes of text for each word, at least, for the size of the sketch; fewer only make it fuller.
BYTES_PER_WORD = 6
EXACT = "chunk int, shard long, n int, keys binary, more binary"


def _windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Word starts, ends, first words of texts, which window starts lie in one text, and the word hashes."""
    starts, ends, firsts = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    return starts, ends, firsts, whole(firsts, size, max(0, len(starts) - size + 1)), hashes


def _exact_keys(hashes: np.ndarray, inside: np.ndarray, one: np.ndarray, size: int, flags: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct 128-bit keys of the estimated windows in order, how often each is here, and the key number of every such window."""
    a = one[flags]
    b = window_hashes(hashes, size, BASE_TWO)[inside][flags]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(first) - 1
    return a[first], b[first], np.bincount(number, minlength=int(first.sum())), number


def remove_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text", size: int = SIZE, lower: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row; ``lower`` compares words with A-Z lower-cased."""
    total = text_bytes(docs, text)
    layout = Layout(total, total // BYTES_PER_WORD)
    exact_bits = max(0, int(total // BYTES_PER_WORD // SHARD_VALUES).bit_length())
    base = by_chunk(docs, id_, text, layout.chunks)

    def bytes_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = flat(group.column("text"))
        return data, LOWER[data] if lower else data, offsets

    def sketch_chunk(group: pa.Table) -> pa.Table:
        _, data, offsets = bytes_of(group)
        *_, inside, hashes = _windows(data, offsets, size)
        return send(group.column("chunk")[0].as_py(), window_hashes(hashes, size, BASE)[inside], layout)

    def reply_of(table_: pa.Table, kind: int) -> dict[int, bytes]:
        rows = zip(table_.column("kind").to_pylist(), table_.column("shard").to_pylist(), table_.column("bits").to_pylist(), strict=True)
        return {shard: bits for k, shard, bits in rows if k == kind}

    def second_pass(group: pa.Table, reply: pa.Table) -> pa.Table:
        _, data, offsets = bytes_of(group)
        *_, inside, hashes = _windows(data, offsets, size)
        one = window_hashes(hashes, size, BASE)[inside]
        a, b, counts, _ = _exact_keys(hashes, inside, one, size, estimated(one, layout, reply_of(reply, 1)))
        shards = a >> np.uint64(64 - exact_bits) if exact_bits else np.zeros(len(a), np.uint64)
        edges = np.searchsorted(shards, np.arange((1 << exact_bits) + 1, dtype=np.uint64))
        used = [k for k in range(1 << exact_bits) if edges[k] < edges[k + 1]]
        keys = np.stack([a, b], 1)
        spans = [(int(edges[k]), int(edges[k + 1])) for k in used]
        return pa.table({
            "chunk": pa.array([group.column("chunk")[0].as_py()] * len(used), pa.int32()),
            "shard": pa.array(used, pa.int64()),
            "n": pa.array([y - x for x, y in spans], pa.int32()),
            "keys": pa.array([keys[x:y].tobytes() for x, y in spans], pa.binary()),
            "more": pa.array([np.packbits(counts[x:y] > 1).tobytes() for x, y in spans], pa.binary()),
        })

    def merge_exact(group: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k, np.uint64).reshape(-1, 2) for k in group.column("keys").to_pylist()])
        more = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for n, m in zip(group.column("n").to_pylist(), group.column("more").to_pylist(), strict=True)]
        return replies(group, keys[:, 1], keys[:, 0], np.concatenate(more) + 1)

    def cut_out(group: pa.Table, reply: pa.Table) -> pa.Table:
        plain, data, offsets = bytes_of(group)
        starts, ends, firsts, inside, hashes = _windows(data, offsets, size)
        one = window_hashes(hashes, size, BASE)[inside]
        flags = estimated(one, layout, reply_of(reply, 1))
        a, _, _, number = _exact_keys(hashes, inside, one, size, flags)
        back = reply_of(reply, 2)
        shards = a >> np.uint64(64 - exact_bits) if exact_bits else np.zeros(len(a), np.uint64)
        counts = np.bincount(shards.astype(np.int64), minlength=1)
        repeated = [np.unpackbits(np.frombuffer(back[k], np.uint8), count=int(counts[k])) for k in np.flatnonzero(counts)]
        marked = np.zeros(len(inside), bool)
        if repeated:
            flags[flags] = np.concatenate(repeated).astype(bool)[number]
            marked[np.flatnonzero(inside)[flags]] = True
        gone = covered(marked, size, len(starts))
        return _without(group.column("id"), plain, starts, ends, firsts, gone)

    id_type = base.schema["id"].dataType.simpleString()
    sent = base.groupBy("chunk").applyInArrow(sketch_chunk, SENT)
    first = sent.groupBy("shard").applyInArrow(merge, REPLY).withColumn("kind", F.lit(1))
    exact = base.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(second_pass, EXACT)
    second = exact.groupBy("shard").applyInArrow(merge_exact, REPLY).withColumn("kind", F.lit(2))
    result = f"id {id_type}, n_words long, n_removed long, kept string"
    return base.groupBy("chunk").cogroup(first.union(second).groupBy("chunk")).applyInArrow(cut_out, result)


def _without(ids: pa.ChunkedArray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, gone: np.ndarray) -> pa.Table:
    """The kept words of every text, joined by one blank."""
    kept = ~gone
    sums = np.concatenate([[0], np.cumsum(kept)])
    n_words = np.diff(firsts)
    n_kept = sums[firsts[1:]] - sums[firsts[:-1]]
    s, e = starts[kept], ends[kept]
    lengths = e - s + 1  # a blank after each word; the last one of a text is dropped
    out_at = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    out = np.full(total, 32, np.uint8)
    spots = np.ones(total, bool)
    spots[out_at + lengths - 1] = False
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, s, 1)
    np.subtract.at(inside, e, 1)
    out[spots] = data[np.cumsum(inside[:-1]) > 0]
    ends_at = np.concatenate([[0], np.cumsum(lengths)])[sums[firsts]]
    texts = [out[a : max(a, b - 1)].tobytes().decode() for a, b in zip(ends_at, ends_at[1:], strict=False)]
    return pa.table({"id": ids, "n_words": pa.array(n_words.astype(np.int64)), "n_removed": pa.array((n_words - n_kept).astype(np.int64)), "kept": pa.array(texts, pa.string())})


def op3_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that occur elsewhere."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM dw WHERE len(w) >= 35)),
again AS (SELECT doc_id, s FROM wins WHERE g IN (SELECT g FROM wins GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM again) GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(ps), 0) AS r, d.w, g.ps FROM dw d LEFT JOIN gone g USING (doc_id)),
words AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM dw) a
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) b WHERE a.doc_id = b.doc_id AND a.p = b.p)
  GROUP BY doc_id)
SELECT k.doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM kept k LEFT JOIN words USING (doc_id)
"""
