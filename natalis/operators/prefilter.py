"""A Bloom filter of persons that drops records before they are shuffled.

The filter is a table of 64-bit words. A person sets ``BITS`` bits of one word; equal words of all tasks are merged by a bitwise or
before and after a small shuffle. It holds every person it was made of and a few others, so whoever needs
the persons exactly tests them again later. The table has at most ``MOST_WORDS`` rows (some 50 MB) and is
broadcast; with more persons it only becomes fuller and lets more through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.operators.temporal import PERSON
from natalis.sources.tables import cut_lineage

BITS = 4
PERSONS_PER_WORD = 4
MOST_WORDS = 1 << 20


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64(F.col(PERSON)), F.lit(words)).cast("int")


def _mask() -> Column:
    # a second hash, six bits of it for each bit that is set
    spread = F.xxhash64(F.col(PERSON), F.lit("bits"))
    places = [F.shiftright(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BITS)]
    one = F.lit(1).cast("long")
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, place) for place in places])


def person_filter(persons: DataFrame) -> tuple[DataFrame, int]:
    """The filter's words (``_word``, ``_bits``) of the persons named, repeated or not, and their number."""
    known = cut_lineage(persons.select(PERSON).filter(F.col(PERSON).isNotNull()).distinct())
    words = min(MOST_WORDS, max(1, known.count() // PERSONS_PER_WORD))
    merged = known.groupBy(_word(words).alias("_word")).agg(F.bit_or(_mask()).alias("_bits"))
    return cut_lineage(merged), words


def of_persons(records: DataFrame, persons: DataFrame) -> DataFrame:
    """The records of the persons named, and of few others; no record is shuffled."""
    words, number = person_filter(persons)
    found = records.withColumn("_word", _word(number)).join(F.broadcast(words), "_word")
    mask = _mask()
    return found.filter(F.col("_bits").bitwiseAND(mask) == mask).select(*records.columns)
