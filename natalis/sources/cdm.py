"""Clinical source tables in the OMOP Common Data Model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBER = "decimal(24,12)"
# Stands for recorded numbers beyond any use; seven times as much still fits.
OUT_OF_RANGE = 10**10

CONDITION, PROCEDURE, OBSERVATION, MEASUREMENT, DRUG = "Cond", "Proc", "Obs", "Meas", "Drug"

# Closed ranges of ids.
Ranges = Sequence[tuple[int, int]]
# Ranges that a scan is asked for at most; beyond, the closest ones are read as one.
MOST_RANGES = 8


@dataclass(frozen=True)
class Cdm:
    """The nine tables read, of which only the listed columns are touched."""

    condition_occurrence: DataFrame
    procedure_occurrence: DataFrame
    observation: DataFrame
    measurement: DataFrame
    drug_exposure: DataFrame
    concept: DataFrame
    concept_ancestor: DataFrame
    observation_period: DataFrame
    person: DataFrame

    #: Whether concepts are stored columns, by which a reader can skip.
    skips_by_concept = True

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str) -> Cdm:
        return cls._load(lambda name: spark.table(f"{schema}.{name}"))

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Cdm:
        return cls._load(lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}"))

    @classmethod
    def _load(cls, read: Callable[[str], DataFrame]) -> Cdm:
        return cls(**{field.name: read(field.name) for field in fields(Cdm)})

    def conditions(self, listed: Ranges | None = None) -> DataFrame:
        return records(within(self.condition_occurrence, "condition_concept_id", listed), "condition_concept_id", "condition_start_date", CONDITION)

    def procedures(self, listed: Ranges | None = None) -> DataFrame:
        return records(within(self.procedure_occurrence, "procedure_concept_id", listed), "procedure_concept_id", "procedure_date", PROCEDURE)

    def observations(self, listed: Ranges | None = None) -> DataFrame:
        return records(
            within(self.observation, "observation_concept_id", listed),
            "observation_concept_id",
            "observation_date",
            OBSERVATION,
            "value_as_string",
            "value_as_number",
        )

    def measurements(self, listed: Ranges | None = None) -> DataFrame:
        return records(
            within(self.measurement, "measurement_concept_id", listed),
            "measurement_concept_id",
            "measurement_date",
            MEASUREMENT,
            "value_source_value",
            "value_as_number",
        )

    def drugs(self, listed: Ranges | None = None) -> DataFrame:
        return records(within(self.drug_exposure, "drug_concept_id", listed), "drug_concept_id", "drug_exposure_start_date", DRUG)

    def clinical_records(self, listed: Ranges | None = None) -> DataFrame:
        """Every record but drug exposures, in one shape; of concepts in ``listed`` ranges only, where they are given."""
        return _stack(self.conditions(listed), self.procedures(listed), self.observations(listed), self.measurements(listed))

    def all_records(self, listed: Ranges | None = None, listed_drugs: Ranges | None = None) -> DataFrame:
        """Every record, drug exposures included; of concepts in the given ranges only."""
        return _stack(self.clinical_records(listed), self.drugs(listed_drugs))

    def record_count(self, coded: DataFrame) -> int:
        """How many records are coded, for dealing them out: ``coded`` are the records with their codes, of which only concepts and values are read."""
        return coded.count()


def covering(ids: Sequence[int], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most so many closed ranges that hold all ids, parted at the widest gaps."""
    ids = sorted(set(ids))
    widest = sorted(range(1, len(ids)), key=lambda k: ids[k - 1] - ids[k])[: most - 1]
    edges = [0, *sorted(k for k in widest if ids[k] - ids[k - 1] > 1), len(ids)]
    return [(ids[a], ids[b - 1]) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def within(table: DataFrame, column: str, ranges: Ranges | None) -> DataFrame:
    """The rows whose id lies in one of the ranges, as a filter on the stored column that the reader can skip by.

    Files, row groups and pages without such an id are then not read, where ids are stored close together.
    """
    if ranges is None or table.schema[column].dataType.simpleString() not in ("int", "bigint", "smallint"):
        return table
    id_ = F.col(column)
    tests = [id_ == a if a == b else (id_ >= a) & (id_ <= b) for a, b in ranges]
    return table.filter(reduce(or_, tests) if tests else F.lit(False))


def records(
    table: DataFrame, concept: str, date: str, kind: str, text: str | None = None, number: str | None = None
) -> DataFrame:
    """One clinical table as person, concept, date, kind and recorded value."""
    return table.select(
        _as(table, "person_id", "person_id", "bigint"),
        _as(table, concept, "concept_id", "int"),
        _as(table, date, "start_date", "date"),
        F.lit(kind).alias("type"),
        _as(table, text, "value_as_string", "string") if text else F.lit(" ").alias("value_as_string"),
        (_number(F.col(number)) if number else F.lit(None).cast(NUMBER)).alias("value_as_number"),
    )


def _number(value: Column) -> Column:
    """A recorded number; text that is none becomes NULL, a number too large for the type one far out of range."""
    exact, wide = value.try_cast(NUMBER), value.try_cast("double")
    far = F.when(wide < 0, F.lit(-OUT_OF_RANGE)).otherwise(F.lit(OUT_OF_RANGE)).cast(NUMBER)
    return F.when(exact.isNull() & wide.isNotNull(), far).otherwise(exact)


def _as(table: DataFrame, column: str, name: str, kind: str) -> Column:
    """A column under a name and type, left alone where it has both.

    Spark drops an alias that changes nothing from some branches of a plan only,
    and branches that differ do not share their scans.
    """
    known = F.col(column)
    if table.schema[column].dataType.simpleString() != kind:
        known = known.cast(kind)
    elif column == name:
        return known
    return known.alias(name)


def _stack(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
