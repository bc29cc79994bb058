"""Clinical tables and counted events stored in the order in which runs read them.

Records are dealt to files and sorted by concept, so that a run reads only the files, row groups and pages in which
a listed code lies; the hierarchy likewise by ancestor. Counted events are bucketed and sorted by person: a run that starts from
them neither reads records nor shuffles by person. Equal events are one row there, so the size of a bucket is
bounded by its persons and the calendar, however many records a person has.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.sources.cdm import Cdm

# Column by which each table is sorted, and one that parts equal values.
SORTED_BY = {
    "condition_occurrence": ("condition_concept_id", "person_id"),
    "procedure_occurrence": ("procedure_concept_id", "person_id"),
    "observation": ("observation_concept_id", "person_id"),
    "measurement": ("measurement_concept_id", "person_id"),
    "drug_exposure": ("drug_concept_id", "person_id"),
    "concept": ("concept_id",),
    "concept_ancestor": ("ancestor_concept_id", "descendant_concept_id"),
    "observation_period": ("person_id",),
    "person": ("person_id",),
}


def write_records(cdm: Cdm, folder: str) -> None:
    """Store the nine tables as Parquet below ``folder`` for ``Cdm.from_parquet``, replacing those present."""
    for field in fields(Cdm):
        order = SORTED_BY[field.name]
        table = getattr(cdm, field.name)
        dealt = table.repartitionByRange(*order).sortWithinPartitions(*order)
        # rows of a concept stand together, so its column is a few values a page and has exact bounds
        dealt.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{field.name}")


def write_events(counted: DataFrame, table: str, buckets: int) -> None:
    """Store counted events (of a plan: ``plan.counted``) as a table bucketed and sorted by person, replacing the one present."""
    dealt = counted.repartition(buckets, "person_id")
    dealt.write.mode("overwrite").bucketBy(buckets, "person_id").sortBy("person_id").saveAsTable(table)


def read_events(spark: SparkSession, table: str) -> DataFrame:
    """Counted events as ``write_events`` stored them."""
    return spark.table(table).select("person_id", "for_drug", "category", "day", "gest_value", F.col("n"))
