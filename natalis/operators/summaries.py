"""Tables made from the finished episodes."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.classify import OUTCOME_CONCEPTS
from natalis.functions.days import lookup
from natalis.lookups import values
from natalis.sources.tables import cut_lineage

# Bits that hold a row's place in its partition in the ids that Spark gives out; the partition stands above them.
PLACE_BITS = 33


def add_global_number(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Number all rows from 1 in ``order`` without one global sort.

    The rows are dealt to ranges, sorted inside them and stored; a row's number is its place in its
    range and the rows of the ranges before, of which there are as many as partitions.
    """
    ranges = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = ranges.withColumn("_range", F.spark_partition_id())
    sizes = placed.groupBy("_range").count().orderBy("_range").collect()
    before = [(r["_range"], n) for r, n in zip(sizes, accumulate((r["count"] for r in sizes), initial=0), strict=False)]
    offsets = values(rows.sparkSession, before or [(0, 0)], "_range int, _before bigint")
    inside = F.monotonically_increasing_id().bitwiseAND((1 << PLACE_BITS) - 1)
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_inside") + 1)
        .drop("_range", "_inside", "_before")
    )


def outcome_concept() -> Column:
    """Concept id of the recorded outcome, 0 for one without."""
    return F.coalesce(lookup("original_outcome", OUTCOME_CONCEPTS), F.lit(0)).cast("double")


def mother_table(episodes: DataFrame) -> DataFrame:
    """Episodes under the names and concept ids of the mother table.

    Reads ``episodes`` more than once: pass a stored or checkpointed table.
    """
    return add_global_number(episodes, "pregnancy_id", "person_id", "episode").select(
        "person_id",
        "pregnancy_id",
        F.col("episode_start_date").alias("pregnancy_start_date"),
        F.col("episode_end_date").alias("pregnancy_end_date"),
        F.col("episode_length").alias("gestational_length_in_day"),
        outcome_concept().alias("original_outcome"),
        F.lit(None).cast("int").alias("pregnancy_mode_delivery"),
        F.lit(None).cast("int").alias("pregnancy_single"),
        (F.col("episode") - 1).alias("prev_pregnancy_gravidity"),
    )


def length_histogram(episodes: DataFrame, first_year: int = 1987, last_year: int = 2013) -> DataFrame:
    """Births per ten days of length; lengths below zero fall in no bin."""
    length = F.col("episode_length")
    born = F.col("original_outcome").isin("LB", "DELIV")
    in_years = F.year("episode_start_date").between(first_year, last_year)
    week = F.when(length >= 0, F.floor(length / 10)).cast("int")
    return (
        episodes.filter(born & in_years & (length < 310) & (length != 0))
        .groupBy(week.alias("week"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def episodes_per_person(episodes: DataFrame) -> DataFrame:
    """Number of persons by number of episodes."""
    each = episodes.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_pregnancies"))
    return each.groupBy("n_pregnancies").agg(F.count(F.lit(1)).alias("n"))


def outcome_counts(episodes: DataFrame) -> DataFrame:
    """Episodes by recorded outcome."""
    return episodes.groupBy("original_outcome").agg(F.count(F.lit(1)).alias("n"))


def outcome_concept_counts(episodes: DataFrame) -> DataFrame:
    """Episodes by the outcome's concept id, which joins outcomes that share one."""
    return episodes.groupBy(outcome_concept().alias("original_outcome")).agg(F.count(F.lit(1)).alias("n"))
