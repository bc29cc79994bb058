"""Recorded weeks beyond any use neither end a run nor fall back to the code's weeks."""

import pytest
from pyspark.sql import functions as F

from natalis import EpisodePlan, Lookups
from natalis.lookups import KEYS, SCHEMAS, values
from natalis.operators.events import gestation_days
from natalis.operators.events import counted_events
from natalis.operators.starts import evidence
from natalis.sources.cdm import NUMBER, records
from natalis.sources.tables import load_lookups
from tests.clinic import cdm, codes


@pytest.mark.parametrize("code_weeks", [30, None])
@pytest.mark.parametrize(
    ("recorded", "kept"),
    [("999999999999", False), ("1e13", False), ("1e300", False), ("-999999999999", True), ("43", True), ("43.1", False), ("ten", None), (None, None)],
)
def test_recorded_weeks(spark, recorded, code_weeks, kept):
    row = spark.createDataFrame(
        [(1, 2, None, recorded)], "person_id long, c int, d date, number string"
    )
    row = records(row, "c", "d", "Observation", number="number")
    row = row.select("value_as_number", F.lit(code_weeks).cast("int").alias("gest_value"), F.lit("GEST").alias("category"), F.lit(False).alias("for_drug"))
    days = row.select(gestation_days().alias("days")).first().days
    if kept is None:
        assert days == (None if code_weeks is None else 7 * code_weeks)
    else:
        assert (days <= 301) is kept


def test_lookups_keep_ids_and_refuse_what_they_cannot_hold(spark):
    fixed = Lookups.fixed()
    ids = [r.outcome_limit_id for r in fixed.tables(spark)["outcome_limit"].collect()]
    assert ids == [*range(1, 9), *range(11, 52)]
    tables = fixed.tables(spark)
    assert Lookups._read(tables) == fixed
    again = tables["gest_est"].limit(1)
    with pytest.raises(ValueError, match="repeated"):
        Lookups._read(tables | {"gest_est": tables["gest_est"].union(again)})
    short = values(spark, [("LB", 301, 0, 28)], SCHEMAS["term_durations"])
    with pytest.raises(ValueError, match="min_term"):
        Lookups._read(tables | {"term_durations": short})
    assert set(KEYS) == set(SCHEMAS)


def gestation(spark, weeks):
    """Coded gestation records of one person and day."""
    return spark.createDataFrame([(w,) for w in weeks], "weeks string").selectExpr(
        "1L AS person_id",
        "false AS for_drug",
        "'GEST' AS category",
        "DATE '2020-03-01' AS start_date",
        f"CAST(NULL AS {NUMBER}) AS gest_value",
        f"CAST(weeks AS {NUMBER}) AS value_as_number",
    )


def test_rows_of_a_day_are_bounded_by_start_days(spark):
    weeks = [f"{10 + i / 1000:.3f}" for i in range(2000)] + ["10", "10", "43", "43.0000000001", "44"]
    coded = gestation(spark, weeks)
    assert counted_events(coded).count() == len(set(map(float, weeks)))
    cut = counted_events(coded, exact=False)
    # 70 to 84 days in steps of a half, 301 days, and one row of what is unusable
    assert cut.count() <= 2 * 14 + 1 + 2
    assert cut.agg(F.sum("n")).first()[0] == len(weeks)
    assert cut.filter("gest_value IS NULL").first().n == 2

    def starts(counted):
        found = evidence(counted.filter("gest_value <= 301"))
        return {tuple(r) for r in found.select("start_floor", "start_ceil").collect()}

    assert starts(cut) == starts(counted_events(coded))


def test_weeks_far_below_zero_date_no_start(spark):
    far = counted_events(gestation(spark, ["-9999999999", "-99999999999"]), exact=False)
    assert far.count() == 1
    assert evidence(far).filter("start_floor < 3000000").count() == 0
    plan = EpisodePlan(cdm(spark, [(1, "LB", 400), (1, "UP", 200)]), codes(spark))
    assert plan.episodes.count() == 1


def test_every_file_of_a_folder_becomes_a_table(spark, tmp_path):
    folder = tmp_path / "lookups"
    folder.mkdir()
    for name, table in Lookups.fixed().tables(spark).items():
        table.toPandas().to_csv(folder / f"{name}.csv", index=False)
    (folder / "pregnancy_concepts.csv").write_text("concept_id,category,gest_value,data_value\n1,LB,,N/A\n2,GEST,30,N/A\n")
    (folder / "own_table.csv").write_text("a,b\n1,x\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS folder_of_files")
    load_lookups(spark, str(folder), "folder_of_files")
    assert Lookups.from_tables(spark, "folder_of_files") == Lookups.fixed()
    stored = spark.table("folder_of_files.pregnancy_concepts")
    assert sorted(map(tuple, stored.collect())) == [(1, "LB", None, "N/A"), (2, "GEST", 30, "N/A")]
    assert stored.schema["gest_value"].dataType.simpleString() == "int"
    assert spark.table("folder_of_files.own_table").dtypes == [("a", "int"), ("b", "string")]
