"""Which dated outcomes become episodes, and how they are reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.functions.classify import FEMALE, outcome_class
from natalis.functions.days import date_of, day_of
from natalis.operators.temporal import PERSON, count_copies, expand_copies, first_number, whole_person
from natalis.options import Options


def within_enrolment(episodes: DataFrame, observation_period: DataFrame) -> DataFrame:
    """Episodes inside an observation period, with ``n``, the periods that hold them.

    No period meets an episode as a row. A person's episodes stand in a row by falling end, each with the earliest
    start from there on. The ends up to that of a period and the starts from its beginning on are then one run of
    this row, whose places the period finds by counting along two time lines; n is the running sum of the runs' edges. Only
    an episode that a later one overlaps may start later than that, and is also tried with each period by itself. Equal periods are counted first.
    """
    periods = count_copies(
        observation_period.filter("observation_period_start_date IS NOT NULL AND observation_period_end_date IS NOT NULL"),
        PERSON,
        day_of("observation_period_start_date").alias("_start"),
        day_of("observation_period_end_date").alias("_end"),
    )
    own = F.struct(*(c for c in episodes.columns if c != PERSON))
    first_day = F.least("start_day", "end_day")
    falling = Window.partitionBy(PERSON).orderBy(F.col("end_day").desc(), first_day.desc())
    placed = episodes.filter("start_day IS NOT NULL AND end_day IS NOT NULL").select(
        PERSON,
        own.alias("_own"),
        F.row_number().over(falling).alias("_place"),
        first_day.alias("_first"),
        F.min(first_day).over(falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_start"),
        F.col("end_day").alias("_end"),
    )
    line = placed.unionByName(periods, allowMissingColumns=True)
    is_episode = F.col("_own").isNotNull()
    overlapped = F.struct("_place", "_first", "_start", "_end")
    one = is_episode.cast("int")
    by_end = Window.partitionBy(PERSON).orderBy(F.col("_end").desc(), one)
    by_start = Window.partitionBy(PERSON).orderBy(F.col("_start").desc(), F.lit(1) - one)
    before = (Window.unboundedPreceding, Window.currentRow)
    counted = line.select(
        "*",
        F.sum(one).over(by_end.rowsBetween(*before)).alias("_after"),
        F.sum(one).over(by_start.rowsBetween(*before)).alias("_upto"),
        F.collect_list(F.when(is_episode & (F.col("_first") > F.col("_start")), overlapped)).over(whole_person()).alias("_overlapped"),
    )

    def edge(place: Column, n: Column) -> Column:
        return F.struct(place.cast("long").alias("_at"), n.cast("long").alias("_n"))

    apart = F.filter(
        "_overlapped",
        lambda e: (e["_start"] < F.col("_start")) & (F.col("_start") <= e["_first"]) & (e["_end"] <= F.col("_end")),
    )
    run = F.array(edge(F.col("_after"), F.col("n")), edge(F.col("_upto"), -F.col("n")))
    single = F.flatten(F.transform(apart, lambda e: F.array(edge(e["_place"] - 1, F.col("n")), edge(e["_place"], -F.col("n")))))
    edges = (
        F.when(is_episode, F.array(edge(F.col("_place"), F.lit(0))))
        .when(F.col("_after") < F.col("_upto"), F.concat(run, single))
        .otherwise(single)
    )
    # an edge counts for the places behind its own
    running = Window.partitionBy(PERSON).orderBy("_at", F.lit(1) - one).rowsBetween(*before)
    held = counted.select(PERSON, "_own", F.inline(edges)).withColumn("n", F.sum("_n").over(running))
    return held.filter(is_episode & (F.col("n") > 0)).select(PERSON, "_own.*", "n")


def of_women_of_age(episodes: DataFrame, person: DataFrame, options: Options) -> DataFrame:
    """Episodes of women between the age limits in the year the episode starts."""
    women = person.filter(F.col("gender_concept_id") == FEMALE).select(PERSON, "year_of_birth")
    age = F.year(date_of("start_day")) - F.col("year_of_birth")
    return (
        episodes.join(women, PERSON)
        .filter(age.between(options.min_age, options.max_age))
        .drop("year_of_birth")
    )


def eligible_episodes(
    chosen: DataFrame, observation_period: DataFrame, person: DataFrame, options: Options
) -> DataFrame:
    """Episodes that pass enrolment, sex and age, numbered by start date per person.

    An episode held by several overlapping periods appears once for each.
    """
    enrolled = within_enrolment(of_women_of_age(chosen, person, options), observation_period)
    numbered = enrolled.withColumn("episode", first_number("n", "start_day", "end_day"))
    return expand_copies(numbered, "episode")


def corroborated(eligible: DataFrame, options: Options) -> DataFrame:
    """Episodes with enough records over the longest term of their outcome."""
    return eligible.filter(F.col("records") >= options.min_records)


def final_episodes(episodes: DataFrame) -> DataFrame:
    """The result table."""
    length = F.col("end_day") - F.col("start_day") + 1
    return episodes.select(
        PERSON,
        date_of("start_day").alias("episode_start_date"),
        date_of("end_day").alias("episode_end_date"),
        F.col("start_category").alias("start_method"),
        F.col("category").alias("original_outcome"),
        "episode",
        outcome_class(F.col("category"), length).alias("outcome"),
        length.alias("episode_length"),
    )
