"""From clinical records to numbered events per person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.classify import (
    DRUG_CATEGORIES,
    DRUG_CLASSES,
    MAX_GESTATION_DAYS,
    TARGETS,
    matches_value,
    usable_event,
)
from natalis.functions.days import ceil_day, date_of, day_of, floor_day, gestation_start_micros
from natalis.operators.temporal import (
    BROADCAST_ROWS,
    PERSON,
    broadcast_if_small,
    count_copies,
    expand_copies,
    first_number,
    whole_person,
)
from natalis.sources.cdm import DRUG, MEASUREMENT, NUMBER, OBSERVATION, OUT_OF_RANGE, Cdm, Ranges, covering, within
from natalis.sources.tables import cut_lineage

# Equal events aside, this order is total; a missing gestation comes first.
EVENT_ORDER = ("day", "category", "gest_value")


def drug_codes(cdm: Cdm, codes: DataFrame, listed_ids: Ranges | None = None) -> DataFrame:
    """Drug concepts below the listed drug codes, one row per way of reaching them.

    ``listed_ids`` are ranges that hold all listed codes: nothing else of the hierarchy is read.
    """
    listed = codes.filter(F.col("category").isin(*DRUG_CATEGORIES)).select(
        F.col("concept_id").alias("ancestor_concept_id"), "category", "gest_value"
    )
    below = within(cdm.concept_ancestor, "ancestor_concept_id", listed_ids).join(listed, "ancestor_concept_id").select(
        F.col("descendant_concept_id").alias("concept_id"), "category", "gest_value"
    )
    drugs = cdm.concept.filter(F.col("concept_class_id").isin(*DRUG_CLASSES)).select("concept_id")
    return below.join(drugs, "concept_id")


def code_map(cdm: Cdm, codes: DataFrame, listed_ids: Ranges | None = None) -> DataFrame:
    """Codes for clinical records and, marked ``for_drug``, for drug exposures."""
    clinical = codes.select(
        F.lit(False).alias("for_drug"), "concept_id", "category", "gest_value", "data_value"
    )
    drug = drug_codes(cdm, codes, listed_ids).select(
        F.lit(True).alias("for_drug"),
        "concept_id",
        "category",
        "gest_value",
        F.lit("N/A").alias("data_value"),
    )
    both = clinical.unionByName(drug).filter(F.col("concept_id").isNotNull())
    # Never null by its type too: no branch of a plan then adds a test of its own.
    return both.withColumn("concept_id", F.coalesce("concept_id", F.lit(0)))


def id_ranges(ids: DataFrame, group: str) -> dict[object, list[tuple[int, int]]]:
    """For every value of ``group`` a few ranges that hold all its ``concept_id`` in a stored table.

    Up to ``BROADCAST_ROWS`` ids are looked at one by one; of more, a group has the range from its least to its largest.
    """
    some = ids.select(group, "concept_id").distinct().limit(BROADCAST_ROWS + 1).collect()
    if len(some) > BROADCAST_ROWS:
        ends = ids.groupBy(group).agg(F.min("concept_id"), F.max("concept_id")).collect()
        return {value: [(least, largest)] for value, least, largest in ends}
    known = sorted({value for value, _ in some})
    return {value: covering([i for v, i in some if v == value]) for value in known}


def coded_records(cdm: Cdm, codes: DataFrame) -> DataFrame:
    """Every record with its codes.

    Only ranges of concepts that hold a listed code are asked of the tables, and of the hierarchy only
    ranges that hold a listed drug code, so that readers skip what is stored elsewhere.
    """
    if not cdm.skips_by_concept:
        return map_codes(cdm.all_records(), code_map(cdm, codes))
    drugs = codes.filter(F.col("category").isin(*DRUG_CATEGORIES) & F.col("concept_id").isNotNull())
    above = id_ranges(drugs.withColumn("for_drug", F.lit(True)), "for_drug")
    mapping = cut_lineage(code_map(cdm, codes, above.get(True, [])))
    listed = id_ranges(mapping, "for_drug")
    records = cdm.all_records(listed.get(False, []), listed.get(True, []))
    return _coded(records, broadcast_if_small(mapping, stored=True))


def map_codes(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Records joined to their codes, of which there may be any number."""
    return _coded(records, broadcast_if_small(mapping))


def _coded(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Records joined to their codes; recorded values only narrow observations and measurements."""
    coded = records.withColumn("for_drug", F.col("type") == DRUG)
    valued = F.col("type").isin(OBSERVATION, MEASUREMENT)
    return coded.join(mapping, ["for_drug", "concept_id"]).filter(
        ~valued | matches_value(F.col("data_value"), F.col("value_as_string"))
    )


def gestation_days() -> Column:
    """Gestational age in days: recorded weeks, else the code's; drug codes keep their value."""
    weeks = F.coalesce(F.col("value_as_number"), F.col("gest_value"))
    # Numbers beyond any use stay out of range, but seven times as much must fit the type.
    low, high = F.lit(-OUT_OF_RANGE).cast(NUMBER), F.lit(OUT_OF_RANGE).cast(NUMBER)
    weeks = F.when(weeks.isNotNull(), F.greatest(F.least(weeks, high), low))
    return (
        F.when(F.col("for_drug"), F.col("gest_value"))
        .when(F.col("category") == "GEST", 7 * weeks)
        .cast(NUMBER)
    )


def start_bound_days() -> Column:
    """Gestation cut to what a start depends on: whole days, or half a day more for any part of one.

    The first and the last day that a start touches stay the same. What is unusable becomes NULL.
    """
    gest = F.col("gest_value")
    micros = gestation_start_micros(F.lit(0), gest)
    cut = (2 - floor_day(micros) - ceil_day(micros)) / F.lit(2).cast("decimal(1,0)")
    recorded = (F.col("category") == "GEST") & ~F.col("for_drug")
    return F.when(recorded, F.when(gest <= MAX_GESTATION_DAYS, cut)).otherwise(gest).cast(NUMBER)


def counted_events(coded: DataFrame, exact: bool = True) -> DataFrame:
    """Coded records as distinct events with their number of copies ``n``.

    Unless ``exact``, gestation is cut to whole and half days: however many different values
    a person has, the rows of a day are bounded by the days on which a start can lie.
    """
    events = coded.select(
        PERSON,
        "for_drug",
        "category",
        day_of("start_date").alias("day"),
        gestation_days().alias("gest_value"),
    )
    events = events.filter(F.col(PERSON).isNotNull())
    if not exact:
        events = events.withColumn("gest_value", start_bound_days())
    return count_copies(events, PERSON, "for_drug", "category", "day", "gest_value")


def glucose_only() -> Column:
    """Whether the person has glucose tests and no other category (drugs aside)."""
    category = F.when(~F.col("for_drug"), F.col("category"))
    first, last = F.min(category).over(whole_person()), F.max(category).over(whole_person())
    only = (first == "DIAB") & (last == "DIAB")
    return F.coalesce(only, F.lit(False))


def clean_events(counted: DataFrame) -> DataFrame:
    """Drop glucose-only persons, unusable gestation records and drugs of unseen persons.

    Adds ``person_records``, the records the person had before, and
    ``has_target``, whether the person has an outcome that can be accepted.
    """
    usable = F.col("for_drug") | usable_event(F.col("category"), F.col("gest_value"))
    flagged = counted.withColumn("_usable", F.coalesce(usable, F.lit(False))).select(
        "*",
        glucose_only().alias("_glucose_only"),
        F.max(~F.col("for_drug") & F.col("_usable")).over(whole_person()).alias("_seen"),
        F.max(F.col("category").isin(*TARGETS)).over(whole_person()).alias("has_target"),
        F.sum("n").over(whole_person()).alias("person_records"),
    )
    # Every branch of a plan reads n here, so all of them share the shuffle by person.
    kept = F.col("_usable") & ~F.col("_glucose_only") & F.col("_seen") & (F.col("n") > 0)
    return flagged.filter(kept).drop("_usable", "_glucose_only", "_seen")


def number_events(cleaned: DataFrame) -> DataFrame:
    """Give each event the number of its first copy in date order.

    Returns person, category, day, gest_value, n and event_id: ``n`` equal
    records form one row and take the numbers from ``event_id`` on.
    """
    return cleaned.select(
        PERSON, "category", "day", "gest_value", "n", first_number("n", *EVENT_ORDER).alias("event_id")
    )


def numbered_events(events: DataFrame) -> DataFrame:
    """Every event as a row of its own, with its number and date."""
    each = expand_copies(events.select(PERSON, "category", "day", "gest_value", "event_id", "n"), "event_id")
    return each.select(PERSON, "event_id", "category", date_of("day").alias("event_date"), "gest_value")
