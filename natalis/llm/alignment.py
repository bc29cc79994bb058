"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file), B a SentencePiece model with byte fallback. Both read a text
behind one blank. Their tokens are taken as bytes, and the ends of the tokens are two ascending lists. They are
intersected by galloping: every end of the shorter list looks for its place in the longer one by steps that
double, then by halving the last step, from where the block of ends before it stopped. Common indices cut both token
lists into groups; differences of ranks give the range of B tokens that every A token overlaps.

An A and a B token that end at the same byte are a link. Corpus counts of linked id pairs are summed from
chunks of documents: a chunk sends each of its pairs once with its count, and gets the corpus count of each back,
so that a pair that stands in every document meets in one place no more often than there are chunks, and no table of
pairs is ever in one place. Every text is encoded once; what its links need is written to the shared folder.

Defined results: a text that is null, empty, or whose joined A or B bytes differ from the blank and the text (B changes
some characters and joins blanks of other kinds) has no tokens: zeros and no groups. Rows of equal id are documents
of their own, null ids included. Special tokens' strings are plain text. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from natalis.llm.base import stored, table
from natalis.llm.textarrays import slices

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: How tokenizer A splits text before it merges bytes: a fixed value of its kind of vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text that a chunk and a step within it take, about; a longer text has one of its own.
CHUNK_BYTES, STEP_BYTES = 8 << 20, 1 << 19
#: Ends that gallop from the same place.
BLOCK = 1024
#: Runs of blanks on which the faster encoder of A's vocabulary fails; texts with one are encoded by the slower library.
LONG_BLANKS = re.compile(r"\s{20000}")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with every token's bytes and number of bytes by id."""

    def __init__(self, a_file: str, b_file: str):
        with open(a_file, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["id"] for t in model["added_tokens"]}
        letters = byte_letters()
        # the ids of a byte-level vocabulary are its merges' order
        ranks = {bytes(letters[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if i not in special}
        self.a_file = a_file
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.a_bytes[i] = piece
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """The ids of A and of B; none at all where the bytes of either aren't those of the text."""
        if not text:
            return [], []
        plain = b" " + text.encode()
        a = self.slow_a.encode(" " + text, add_special_tokens=False).ids if LONG_BLANKS.search(text) else self.a.encode_ordinary(" " + text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != plain:
            return [], []
        b = self.b.encode(text)
        return (a, b) if b"".join(map(self.b_bytes.__getitem__, b)) == plain else ([], [])

    @cached_property
    def slow_a(self) -> Tokenizer:
        out = Tokenizer.from_file(self.a_file)
        out.encode_special_tokens = True
        return out

    @cached_property
    def names(self) -> list[str]:
        """Every id in decimal after each sign that may stand before it."""
        most = max(len(self.a_bytes), len(self.b_bytes))
        return [f"{sign}{i}" for sign in ("", ",", "|", ";") for i in range(most)]


@cache
def tokenizers(a_file: str, b_file: str) -> Tokenizers:
    """Loaded once for each Python worker."""
    return Tokenizers(a_file, b_file)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every value of an ascending list how many values of a longer ascending one are smaller."""
    out = np.empty(len(short), np.int64)
    if not len(long):
        return np.zeros(len(short), np.int64)
    base, last = 0, len(long) - 1
    for at in range(0, len(short), BLOCK):
        wanted = short[at : at + BLOCK]
        low, step, open_ = np.full(len(wanted), base), np.ones(len(wanted), np.int64), np.arange(len(wanted))
        while len(open_):
            probe = low[open_] + step[open_] - 1
            open_ = open_[(probe <= last) & (long[np.minimum(probe, last)] < wanted[open_])]
            low[open_] += step[open_]
            step[open_] *= 2
        high = np.minimum(low + step - 1, len(long))
        while (low < high).any():
            middle = (low + high) >> 1
            less = (low < high) & (long[np.minimum(middle, last)] < wanted)
            high = np.where(less, high, np.minimum(middle, high))
            low = np.where(less, middle + 1, low)
        out[at : at + BLOCK] = low
        base = int(low[-1])
    return out


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices in a and in b of the values that both ascending lists have."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    rank = gallop(short, long)
    both = np.flatnonzero(long[np.minimum(rank, len(long) - 1)] == short) if len(long) else np.zeros(0, np.int64)
    return (both, rank[both]) if short is a else (rank[both], both)


@dataclass
class Aligned:
    """The tokens of several texts one after the other, and where they end together.

    ``firsts_a`` and ``firsts_b`` have the number of each text's first token (and the end); ``at_a`` and ``at_b`` the
    numbers of the tokens that end together, of which the last of each text are one pair.
    """

    a: np.ndarray
    b: np.ndarray
    firsts_a: np.ndarray
    firsts_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], own: Tokenizers) -> Aligned:
        ids = [own.encode(t) for t in texts]
        sides = []
        for k, lengths in ((0, own.a_lengths), (1, own.b_lengths)):
            firsts = np.concatenate([[0], np.cumsum([len(x[k]) for x in ids], dtype=np.int64)])
            flat = np.array([i for x in ids for i in x[k]], np.int64)
            # texts one after the other: equal bytes in both, so ends of different texts never meet
            sides += [flat, firsts, np.cumsum(lengths[flat])]
        a, firsts_a, ends_a, b, firsts_b, ends_b = sides
        return cls(a, b, firsts_a, firsts_b, ends_a, ends_b, *common(ends_a, ends_b))

    @cached_property
    def firsts(self) -> np.ndarray:
        """The number of each text's first group (and the end)."""
        return np.searchsorted(self.at_a, self.firsts_a)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """For every A token the first B token that shares a byte with it, and the one after the last."""
        starts = np.concatenate([[0], self.ends_a[:-1]])
        return np.searchsorted(self.ends_b, starts, "right"), np.searchsorted(self.ends_b, self.ends_a, "left") + 1

    def group_texts(self, own: Tokenizers) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` for every text."""
        before_a, before_b = (np.concatenate([[0], at + 1]) for at in (self.at_a, self.at_b))
        of_a, of_b = (np.repeat(np.arange(len(self.at_a)), np.diff(x)) for x in (before_a, before_b))
        width = len(own.names) // 4
        # signs: 0 none, 1 comma, 2 bar before a group's first B token, 3 semicolon before its first A token
        sign_a, sign_b = np.full(len(self.a), width), np.full(len(self.b), width)
        sign_a[before_a[:-1]], sign_b[before_b[:-1]] = 3 * width, 2 * width
        sign_a[self.firsts_a[:-1][np.diff(self.firsts_a) > 0]] = 0
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[of_a]] = self.a + sign_a
        codes[np.arange(len(self.b)) + before_a[of_b + 1]] = self.b + sign_b
        edges = self.firsts_a + self.firsts_b
        for low, high in zip(edges, edges[1:], strict=False):
            yield "".join(map(own.names.__getitem__, codes[low:high].tolist()))


def alignments(docs: DataFrame, id_: str = "doc_id", text: str = "text", folder: str = FOLDER, a: str = FILE_A, b: str = FILE_B) -> DataFrame:
    """(id, a, b, a_cuts, b_cuts, b_from, b_to): token ids, how many tokens of each stand before the end of each
    group, and the range of B tokens (from, to not included) that every A token overlaps.
    """
    docs = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(f"{folder}/{a}", f"{folder}/{b}")
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                found = Aligned.of(part.column("text").to_pylist(), own)
                low, high = found.overlaps()
                cuts = [(found.at_a + 1, found.firsts_a, found.firsts), (found.at_b + 1, found.firsts_b, found.firsts)]
                lists = [_lists(found.a, found.firsts_a), _lists(found.b, found.firsts_b)]
                lists += [_lists(at - np.repeat(base[:-1], np.diff(firsts)), firsts) for at, base, firsts in cuts]
                base_b = np.repeat(found.firsts_b[:-1], np.diff(found.firsts_a))
                lists += [_lists(low - base_b, found.firsts_a), _lists(high - base_b, found.firsts_a)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *lists], names=["id", "a", "b", "a_cuts", "b_cuts", "b_from", "b_to"])

    return docs.mapInArrow(rows, f"id {id_type}, a array<int>, b array<int>, a_cuts array<int>, b_cuts array<int>, b_from array<int>, b_to array<int>")


def _lists(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(values, pa.int32()))


def _encoded(docs: DataFrame, id_: str, text: str, a_file: str, b_file: str) -> DataFrame:
    """(chunk, id, n_a, n_b, n_groups, groups_sha256, pairs, counts): every document once, its distinct linked pairs as
    a * (B ids) + b in 64 bits and how often each is linked, in chunks of rows that are one task's neighbours.
    """
    docs = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(a_file, b_file)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for large in slices(batch, "text", CHUNK_BYTES):
                for part in slices(large, "text", STEP_BYTES):
                    yield _row_batch(part, own, chunk)
                chunk += 1

    return docs.mapInArrow(rows, f"chunk long, id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, counts binary")


def _row_batch(part: pa.RecordBatch, own: Tokenizers, chunk: int) -> pa.RecordBatch:
    found = Aligned.of(part.column("text").to_pylist(), own)
    links = found.a[found.at_a] * len(own.b_bytes) + found.b[found.at_b]
    distinct = [np.unique(links[low:high], return_counts=True) for low, high in zip(found.firsts, found.firsts[1:], strict=False)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(part.num_rows, chunk, np.int64)),
            part.column("id"),
            pa.array(np.diff(found.firsts_a)),
            pa.array(np.diff(found.firsts_b)),
            pa.array(np.diff(found.firsts)),
            pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.group_texts(own)], pa.string()),
            pa.array([np.diff(pairs, prepend=0).astype(np.uint32).tobytes() for pairs, _ in distinct], pa.binary()),
            pa.array([counts.astype(np.uint32).tobytes() for _, counts in distinct], pa.binary()),
        ],
        names=["chunk", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "counts"],
    )


def _read_links(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' pairs, their counts, and the number of each row's first pair (and the end)."""
    steps, counts = (rows.column(k).to_pylist() for k in ("pairs", "counts"))
    pairs = [np.cumsum(np.frombuffer(s, np.uint32), dtype=np.int64) for s in steps]
    firsts = np.concatenate([[0], np.cumsum([len(p) for p in pairs], dtype=np.int64)])
    return np.concatenate([np.zeros(0, np.int64), *pairs]), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64), firsts


def _sums(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every distinct pair and the sum of its counts."""
    names, number = np.unique(pairs, return_inverse=True)
    return names, np.bincount(number, counts, len(names)).astype(np.int64)


def _asked(encoded: DataFrame) -> DataFrame:
    """(chunk, pair, n): the distinct pairs of every chunk, in parts as its batches come."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])), len(chunks)) if len(chunks) else [0]
            for low, high in zip(edges, edges[1:], strict=False):
                pairs, counts, _ = _read_links(batch.slice(int(low), int(high - low)))
                names, sums = _sums(pairs, counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), chunks[low], np.int64)), pa.array(names), pa.array(sums)], names=["chunk", "pair", "n"])

    return encoded.select("chunk", "pairs", "counts").mapInArrow(rows, "chunk long, pair long, n long")


def link_counts(docs: DataFrame, id_: str = "doc_id", text: str = "text", folder: str = FOLDER, a: str = FILE_A, b: str = FILE_B) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    encoded = stored(_encoded(docs, id_, text, f"{folder}/{a}", f"{folder}/{b}"), "alignment")
    id_type = encoded.schema["id"].dataType.simpleString()
    b_size = tokenizers(f"{folder}/{a}", f"{folder}/{b}").b.get_piece_size()
    asked = _asked(encoded)
    totals = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    # one row for each B id
    best = totals.groupBy(F.pmod("pair", F.lit(b_size)).alias("b")).agg(F.max("n").alias("most"))
    told = totals.join(F.broadcast(best), F.pmod("pair", F.lit(b_size)) == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asked.select("chunk", "pair").distinct().join(told, "pair")

    def filled(rows: pa.Table, answer: pa.Table) -> pa.Table:
        pairs, counts, firsts = _read_links(rows)
        names = answer.column("pair").to_numpy()
        order = np.argsort(names)
        at = order[np.searchsorted(names, pairs, sorter=order)] if len(pairs) else np.zeros(0, np.int64)
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * answer.column("best").to_numpy()[at], counts * answer.column("n").to_numpy()[at])]
        found = {k: pa.array(s[firsts[1:]] - s[firsts[:-1]], pa.int64()) for k, s in zip(("n_links", "n_best", "count_sum"), sums, strict=True)}
        return pa.table({k: rows.column(k) for k in ("id", "n_a", "n_b", "n_groups")} | found | {"groups_sha256": rows.column("groups_sha256")})

    return encoded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(filled, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of both tokenizers end together in every document, and how common its links are."""
    found = link_counts(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
