"""Quality from overlapping heuristics: a weak-label model and a hashed linear scorer.

Seven heuristic labellers look at each text and vote good, bad or not at all. Expectation-maximisation
over the counts of vote patterns (at most 3 to the 7, counted over all rows) estimates how often each labeller votes
what for good and for bad texts, and with it the probability that a text of each pattern is good. These
posterior labels train a logistic scorer on hashed words and runs of three character classes; it is fitted
on a bounded sample (``SAMPLE`` different texts, those with the smallest hashes) and scores every row.

Defined results: a null text, an empty one or one without words gets score 0 and is not kept; rows are judged
one by one, so equal texts have equal scores, whatever their ids, null and repeated ones included; an empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import table
from natalis.llm.textarrays import LOWER, flat, slices, span_hashes, words

#: Different texts that the scorer is fitted on, at most.
SAMPLE = 8000
WORD_BITS, CLASSES = 13, 8
FEATURES = (1 << WORD_BITS) + CLASSES**3
SLICE = 1 << 20
#: Labellers by name: vote bad below the first bound, good above the second (or the other way round where the first is larger).
LABELLERS = {
    "symbols per character": (0.02, 0.002),
    "letters and blanks per character": (0.85, 0.93),
    "distinct words per word, mean over runs of 200 words": (0.3, 0.5),
    "words equal to the one before": (0.1, 0.02),
    "distinct lines per line": (0.6, 0.9),
    "words per stop, comma or line end": (60.0, 25.0),
    "mean length of words": (2.2, 3.0),
}
_SYMBOLS = set(b"#$%&*|<>{}[]\\^~_=+@")
_CLASS = np.array([7 if c >= 128 else 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c == 32 else 4 if c in (9, 10, 11, 12, 13) else 5 if c in b".,;:!?'\"-()" else 6 for c in range(256)], np.int64)
#: Words of a run in which distinct words are counted, so that their share doesn't fall with a text's length.
RUN = 200
_IS_SYMBOL = np.array([c in _SYMBOLS for c in range(256)])


def distinct_share(hashes: np.ndarray) -> float:
    """The mean share of distinct words over all consecutive runs of ``RUN`` words; the last one may be shorter."""
    run = np.arange(len(hashes)) // RUN
    order = np.lexsort((hashes, run))
    run, ordered = run[order], hashes[order]
    new = np.append(True, (ordered[1:] != ordered[:-1]) | (run[1:] != run[:-1]))
    return float((np.bincount(run, new) / np.bincount(run)).mean())


def measures(data: np.ndarray, hashes: np.ndarray) -> list[float]:
    """The labellers' values for one text of at least one word."""
    classes = np.bincount(_CLASS[data], minlength=CLASSES)
    n = len(data)
    lines = [x for x in re.split(rb"\n+", data.tobytes()) if x.strip()]
    breaks = int(np.isin(data, np.frombuffer(b".,\n;!?", np.uint8)).sum())
    return [
        float(_IS_SYMBOL[data].sum() / n),
        float((classes[0] + classes[1] + classes[3] + classes[7]) / n),
        distinct_share(hashes),
        float((hashes[1:] == hashes[:-1]).mean()) if len(hashes) > 1 else 0.0,
        len(set(lines)) / len(lines),
        len(hashes) / (breaks + 1),
        float((n - classes[3] - classes[4]) / len(hashes)),
    ]


def pattern(values: list[float]) -> int:
    """The votes as one number in base 3: 0 none, 1 bad, 2 good."""
    out = 0
    for value, (bad, good) in zip(values, LABELLERS.values(), strict=True):
        sign = 1 if good > bad else -1
        vote = 1 if sign * value < sign * bad else 2 if sign * value > sign * good else 0
        out = out * 3 + vote
    return out


def votes(patterns: np.ndarray) -> np.ndarray:
    """The votes of the patterns, one column for each labeller."""
    return np.stack([patterns // 3**k % 3 for k in range(len(LABELLERS) - 1, -1, -1)], 1)


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The probability of good for each pattern, labellers taken as independent given the truth.

    Begins with the majority of votes; every labeller's votes have half a count more for what its name says.
    """
    cast = votes(patterns)
    good, bad = (cast == 2).sum(1), (cast == 1).sum(1)
    p = (good + 1.0) / (good + bad + 2.0)
    for _ in range(rounds):
        weights = np.stack([(1 - p) * counts, p * counts])
        prior = (weights.sum(1) + 1) / (counts.sum() + 2)
        score = np.log(prior)[:, None] + np.zeros_like(weights)
        for k in range(cast.shape[1]):
            table_ = np.stack([np.bincount(cast[:, k], w, 3) for w in weights]) + np.array([[0.5, 1.0, 0.5], [0.5, 0.5, 1.0]])
            score += np.log(table_ / table_.sum(1, keepdims=True))[:, cast[:, k]]
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    return p


def features(data: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text: damped counts of unit length."""
    kinds = _CLASS[data]
    runs = kinds[:-2] * CLASSES * CLASSES + kinds[1:-1] * CLASSES + kinds[2:]
    counts = np.concatenate([np.bincount((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=1 << WORD_BITS), np.bincount(runs, minlength=CLASSES**3)])
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at] / len(hashes) * 100)
    return at.astype(np.int32), (values / max(1e-9, np.sqrt((values * values).sum()))).astype(np.float32)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def __call__(self, at: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ values + self.bias, -50, 50))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by gradient steps of adapted length (Adam) over the whole sample."""
    if not rows:
        return Scorer(np.zeros(FEATURES), 0.0)
    at, values = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    # both kinds weigh the same
    share = np.clip(labels.mean(), 0.01, 0.99)
    weight = labels / share + (1 - labels) / (1 - share)
    weight /= weight.sum()
    w = np.zeros(FEATURES + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.bincount(owner, w[at] * values, len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) * weight
        slope = np.append(np.bincount(at, error[owner] * values, FEATURES), error.sum()) + decay * w
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        w -= 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Scorer(w[:-1], float(w[-1]))


def _texts(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and word hashes (A-Z lower-cased) of every text."""
    data, offsets = flat(part.column("text"))
    low = LOWER[data]
    starts, ends, firsts = words(low, offsets)
    hashes = span_hashes(low, starts, ends)
    for k in range(len(offsets) - 1):
        yield data[offsets[k] : offsets[k + 1]], hashes[firsts[k] : firsts[k + 1]]


def label_patterns(docs: DataFrame) -> DataFrame:
    """(id, pattern, text) of docs (id, text); a text without words has no pattern."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = [pattern(measures(data, hashes)) if len(hashes) else None for data, hashes in _texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.int32())], names=["id", "pattern"])

    return docs.mapInArrow(vote, f"id {docs.schema['id'].dataType.simpleString()}, pattern int")


def _sample(docs: DataFrame, rows: float, most: int) -> DataFrame:
    """(id, text) of the ``most`` different texts with the smallest hashes, one row of each.

    A first cut by hash, three times as wide as needed if all texts differ, keeps the others from being sorted; where
    many rows are equal, it may leave fewer.
    """
    hash_ = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    part = int(min(1.0, 3 * most / rows) * (1 << 30))
    near = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("text", hash_.alias("h")).where(f"h < {part}")
    return near.groupBy("h", "text").agg(F.count("*")).orderBy("h", "text").limit(most).select(F.lit(0).cast("long").alias("id"), "text")


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[Scorer, dict[int, float]]:
    """The scorer, and the posterior of every vote pattern; docs are (id, text)."""
    counts = label_patterns(docs).where("pattern is not null").groupBy("pattern").count().orderBy("pattern").collect()
    patterns, n = np.array([r[0] for r in counts], np.int64), np.array([r[1] for r in counts], np.float64)
    if not len(patterns):
        return Scorer(np.zeros(FEATURES), 0.0), {}
    known = dict(zip(patterns.tolist(), posteriors(patterns, n).tolist(), strict=True))
    chosen = _sample(docs, n.sum(), sample)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                rows = [(features(d, h), pattern(measures(d, h))) for d, h in _texts(piece) if len(h)]
                yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int32()), pa.array([r[0][0] for r in rows], pa.list_(pa.int32())), pa.array([r[0][1] for r in rows], pa.list_(pa.float32()))], names=["pattern", "at", "value"])

    rows = chosen.mapInArrow(describe, "pattern int, at array<int>, value array<float>").toArrow()
    found = sorted(zip(rows.column("pattern").to_pylist(), (np.array(x) for x in rows.column("at").to_pylist()), (np.array(x) for x in rows.column("value").to_pylist()), strict=True), key=lambda r: (r[0], len(r[1]), r[2].tobytes()))
    return fit([(r[1], r[2]) for r in found], np.array([known[r[0]] for r in found])), known


def score(docs: DataFrame, scorer: Scorer, known: dict[int, float], threshold: float = 0.2) -> DataFrame:
    """(id, posterior, score, kept) for every row of docs (id, text); what isn't clearly bad is kept."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                pairs = [(known.get(pattern(measures(d, h)), 0.5), scorer(*features(d, h))) if len(h) else (0.0, 0.0) for d, h in _texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array([p[k] for p in pairs], pa.float64()) for k in (0, 1)), pa.array([p[1] >= threshold for p in pairs], pa.bool_())], names=["id", "posterior", "score", "kept"])

    return docs.mapInArrow(judge, f"id {docs.schema['id'].dataType.simpleString()}, posterior double, score double, kept boolean")


def op10_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document: posterior of the labellers, score of the trained scorer, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return score(docs, *train(docs)).withColumnRenamed("id", "doc_id")
