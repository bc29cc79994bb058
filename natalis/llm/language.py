"""Language identification by multilingual mixtures.

Learning counts byte trigrams inside words for every language over all given rows. A document is a
mixture of languages that emits words; expectation-maximisation estimates its proportions from the
n-gram likelihoods of its words. Languages join a document's set one at a time, the one with the
steepest likelihood first, as long as the likelihood less a penalty for each language rises.

Defined results: a null text, an empty text or one without a letter is ``und`` with score 0; without any
learned language every text is ``und``; rows are judged one by one, so repeated rows agree and other
columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import table
from natalis.llm.textarrays import LOWER, flat, slices, table_of, words

GRAMS = 1 << 16
LETTERS = table_of([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
SLICE = 1 << 20
UNDETERMINED = "und"


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigram number at every letter byte, the first letter of every word, the first word of every text."""
    starts, ends, firsts = words(data, offsets, LETTERS)
    inside = LETTERS[data]
    clean = np.where(inside, LOWER[data], np.uint8(32)).astype(np.uint32)
    before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    before[1:], after[:-1] = clean[:-1], clean[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = 32, 32
    numbers = ((before << np.uint32(16) | clean << np.uint32(8) | after) * np.uint32(2654435761)) >> np.uint32(16)
    lengths = ends - starts
    return numbers[inside], np.cumsum(lengths) - lengths, firsts


@dataclass
class Model:
    """Learned languages and, for every trigram number, its log likelihood in each of them."""

    languages: list[str]
    log_likelihood: np.ndarray
    penalty: float = 4.0  # log likelihood that one more language has to add, times the log of the words
    rounds: int = 12

    def mixtures(self, batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the languages (rows without a word: all 0), and whether the mixture beats uniform n-grams."""
        data, offsets = flat(batch.column(text))
        numbers, letters, firsts = grams(data, offsets)
        counts = np.diff(firsts)
        n, size = len(counts), len(self.languages)
        shares, better = np.zeros((n, size)), np.zeros(n, bool)
        some = np.flatnonzero(counts)
        if not len(some) or not size:
            return shares, better
        by_word = np.stack([np.add.reduceat(self.log_likelihood[:, k][numbers], letters) for k in range(size)], 1)
        at = firsts[:-1][some]
        totals = np.add.reduceat(by_word, at, dtype=np.float64)
        top = by_word.max(1)
        relative = np.exp(by_word - top[:, None])
        base = np.add.reduceat(top, at, dtype=np.float64)
        lengths = np.diff(np.append(letters, len(numbers)))
        pi, likelihood = self._chosen(relative, totals - base[:, None], counts[some])
        shares[some] = pi
        better[some] = likelihood + base > -np.log(GRAMS) * np.add.reduceat(lengths, at)
        return shares, better

    def _chosen(self, relative: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(self.languages)
        pi = np.eye(size, dtype=np.float32)[totals.argmax(1)]
        likelihood = totals.max(1)
        active = np.arange(len(counts))
        for _ in range(size - 1):
            rows, at = self._rows(active, counts)
            part = relative[rows]
            mix = np.einsum("ij,ij->i", part, np.repeat(pi[active], counts[active], 0)) + np.float32(1e-30)
            slope = np.add.reduceat(part / mix[:, None], at, dtype=np.float64) - counts[active][:, None]
            slope[pi[active] > 0] = -np.inf
            rising = slope.max(1) > 1e-6 * counts[active]
            active, slope = active[rising], slope[rising]
            if not len(active):
                break
            trial = pi[active] * np.float32(0.8)
            trial[np.arange(len(active)), slope.argmax(1)] = 0.2
            rows, at = self._rows(active, counts)
            part = relative[rows]
            for _ in range(self.rounds):
                weighted = part * np.repeat(trial, counts[active], 0)
                mix = weighted.sum(1) + np.float32(1e-30)
                trial = (np.add.reduceat(weighted / mix[:, None], at, dtype=np.float64) / counts[active][:, None]).astype(np.float32)
            mix = np.einsum("ij,ij->i", part, np.repeat(trial, counts[active], 0)) + np.float32(1e-30)
            reached = np.add.reduceat(np.log(mix), at, dtype=np.float64)
            won = reached - likelihood[active] > self.penalty * np.log(counts[active] + 1)
            active = active[won]
            pi[active], likelihood[active] = trial[won], reached[won]
            if not len(active):
                break
        return pi, likelihood

    @staticmethod
    def _rows(active: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of the active texts, and where each text's words begin among them."""
        wanted = np.zeros(len(counts), bool)
        wanted[active] = True
        lengths = counts[active]
        return np.repeat(wanted, counts), np.cumsum(lengths) - lengths


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts trigrams of all rows with a text and a language; a partition sends one sum for each language and trigram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text, SLICE):
                codes = pc.dictionary_encode(part.column(lang))
                data, offsets = flat(part.column(text))
                numbers, letters, firsts = grams(data, offsets)
                ends = np.append(letters, len(numbers))[firsts]
                owner = np.repeat(codes.indices.to_numpy(), np.diff(ends))
                names = codes.dictionary.to_pylist()
                found = np.bincount(owner.astype(np.int64) * GRAMS + numbers, minlength=len(names) * GRAMS)
                for k, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + found[k * GRAMS : (k + 1) * GRAMS]
        for name, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])], names=["lang", "gram", "n"])

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    counts = rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("lang").to_pylist()), key=lambda s: s.encode())
    sums = np.zeros((GRAMS, len(languages)))
    if languages:
        names = np.searchsorted(np.array([s.encode() for s in languages]), np.array([s.encode() for s in counts.column("lang").to_pylist()]))
        sums[counts.column("gram").to_numpy(), names] = counts.column("n").to_numpy()
    sums += 0.5
    return Model(languages, np.asfortranarray(np.log(sums / sums.sum(0)), np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (its proportion), ``proportions`` (of the chosen set) and ``known``.

    ``known`` is false where the text has no letter or uniform n-grams explain it better than the mixture.
    Columns of these names are replaced.
    """
    added = "lang_pred string, score double, proportions map<string,double>, known boolean"
    names = ["lang_pred", "score", "proportions", "known"]
    docs = docs.drop(*names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                letter = pc.fill_null(pc.match_substring_regex(part.column(text), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                shares, better = model.mixtures(part, text)
                found = letter & (shares.sum(1) > 0)
                best = shares.argmax(1) if len(model.languages) else np.zeros(len(shares), int)
                value = np.where(found, shares.max(1, initial=0), 0.0)
                pred = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, found, strict=True)]
                sets = [[(model.languages[k], float(row[k])) for k in np.flatnonzero(row)] if ok else [] for row, ok in zip(shares, found, strict=True)]
                more = [pa.array(pred, pa.string()), pa.array(np.clip(value, 0, 1)), pa.array(sets, pa.map_(pa.string(), pa.float64())), pa.array(found & better)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, f"{fields}, {added}")


def held_out(id_: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = identify(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "known")
