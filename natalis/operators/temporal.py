"""Reusable per-person operators: counted copies, look-backs, running counts, greedy acceptance.

All windows of this module partition by person and grow from the start of the
partition, so each costs one pass over a person's rows however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from natalis.sources.tables import cut_lineage

PERSON = "person_id"

# A broadcast table is counted first and may hold this many rows (some 30 MB of codes).
BROADCAST_ROWS = 500_000

# Rows that a task sorts by person, about: a stage holds up to eight sorts of them, some 700 bytes a row.
ROWS_PER_TASK = 500_000

# Copies written out per row by one step of expand_copies.
COPIES_PER_CHUNK = 10_000


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS, stored: bool = False) -> DataFrame:
    """Ask for a broadcast once the table is known to be small.

    The table is stored first, unless it is already, so that the check and all uses compute it once.
    Beyond ``max_rows`` it comes back without a hint: the join then shuffles,
    and adaptive execution splits the skewed partitions.
    """
    known = table if stored else cut_lineage(table)
    return F.broadcast(known) if known.count() <= max_rows else known


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions in which ``rows`` rows are dealt by person: every core has one, and none has more rows however large the input."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def count_copies(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Equal rows as one row with their number ``n``.

    The count is partial before the shuffle and keyed by the whole row, so a
    person holding a large share of the input leaves each task as a few rows.
    """
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def first_number(n: str, *order: str | Column) -> Column:
    """Number of the first copy when all copies of a person are numbered in ``order``."""
    before = Window.partitionBy(PERSON).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(before), F.lit(0)) + 1


def expand_copies(rows: DataFrame, number: str, n: str = "n") -> DataFrame:
    """Write each copy out as a row of its own, numbered on from ``number``.

    Rows with many copies are cut into chunks that are dealt out anew, so that
    they are written by many tasks.
    """
    chunk = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(COPIES_PER_CHUNK).cast("long"))
    keep = [c for c in rows.columns if c not in (number, n)]
    chunks = rows.select("*", F.explode(chunk).alias("_skip")).repartition(PERSON, number, "_skip")
    last = F.least(F.col("_skip") + COPIES_PER_CHUNK, F.col(n)) - 1
    return chunks.select(
        *keep, F.explode(F.sequence(F.col(number) + F.col("_skip"), F.col(number) + last)).alias(number)
    )


def whole_person() -> WindowSpec:
    """All rows of the person."""
    return Window.partitionBy(PERSON)


def up_to(day: str, ahead: int = 0) -> WindowSpec:
    """All rows of the person dated ``ahead`` days after this one or earlier."""
    return Window.partitionBy(PERSON).orderBy(day).rangeBetween(Window.unboundedPreceding, ahead)


def latest_day(event: Column, day: str, ahead: int = 0) -> Column:
    """Day of the person's latest such event up to ``ahead`` days after this row."""
    return F.max(F.when(event, F.col(day))).over(up_to(day, ahead))


def total_within(n: Column | str, day: str, span: int) -> Column:
    """Sum of ``n`` over the ``span`` days that end on this row's day."""
    return F.sum(n).over(up_to(day)) - F.coalesce(F.sum(n).over(up_to(day, -span)), F.lit(0))


def prior_of(sorted_rows: Column, field: str) -> Callable[[Column, Column], Column]:
    """For ``transform`` over a sorted array: ``field`` of the element before."""
    return lambda row, i: F.get(sorted_rows, i - 1)[field]


def with_islands(rows: DataFrame, day: str, reach: int) -> DataFrame:
    """Add ``island``, the number of the person's run of rows that are no more than ``reach`` days apart from one to the next."""
    line = Window.partitionBy(PERSON).orderBy(day)
    begins = (F.col(day) - F.lag(day).over(line) > reach).cast("int")
    return rows.withColumn("_begins", begins).withColumn("island", F.coalesce(F.sum("_begins").over(up_to(day)), F.lit(0))).drop("_begins")


def greedy_accept(
    candidates: DataFrame,
    order: Iterable[str],
    carried: Iterable[str],
    conflict: Callable[[Column, Column], Column],
    apart: Iterable[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Per person, walk the candidates in order and keep those without conflict.

    ``conflict(accepted, candidate)`` tells whether a candidate clashes with one
    accepted before. Returns a row per person, and per value of the columns ``apart`` between which nothing clashes,
    with the array ``accepted``. Parts of one person are dealt out to ``parts`` partitions, if they are given.
    Callers pass one candidate per person, category and day, which bounds a
    person's array by the calendar whatever the number of records.
    """
    keys = (PERSON, *apart)
    queue = F.sort_array(F.collect_list(F.struct(*order, *carried)))
    # dealt out anew by all keys: the parts of one person are walked by many tasks
    dealt = candidates.repartition(*([parts] if parts else []), *keys) if apart else candidates
    per_person = dealt.groupBy(*keys).agg(queue.alias("_queue"))

    def step(kept: Column, candidate: Column) -> Column:
        clash = F.exists(kept, lambda earlier: conflict(earlier, candidate))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(candidate)))

    none = F.filter("_queue", lambda c: F.lit(False))
    return per_person.select(*keys, F.aggregate("_queue", none, step).alias("accepted"))
