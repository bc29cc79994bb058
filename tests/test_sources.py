"""Tables in, tables out."""

import csv
from dataclasses import fields

import pytest

from natalis import Cdm, EpisodePlan, Lookups
from natalis.operators import summaries as su
from natalis.sources import tables
from natalis.sources.fixtures import code_set, fixture_cdm
from tests.clinic import cdm, codes

SF = "/root/testdata/sf0.001"


def test_lookups_round_trip_through_csv(spark, tmp_path):
    fixed = Lookups.fixed()
    for name, table in fixed.tables(spark).items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(table.columns)
            writer.writerows(table.collect())
    assert Lookups.from_csv(spark, str(tmp_path)) == fixed
    spark.sql("CREATE DATABASE IF NOT EXISTS loaded_db")
    tables.load_lookups(spark, str(tmp_path), "loaded_db")
    assert Lookups.from_tables(spark, "loaded_db") == fixed


def test_fixed_lookups():
    fixed = Lookups.fixed()
    assert len(fixed.min_days) == 49
    assert (fixed.min_days["LB", "SB"], fixed.min_days["SB", "LB"]) == (168, 182)
    assert (fixed.max_term["SA"], fixed.min_term["SA"], fixed.retry["SA"]) == (139, 28, 14)
    assert (fixed.preterm["SB"], fixed.nodata["SB"], fixed.postterm["SB"]) == (196, 196, 285)


def test_write_lookups(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lookup_db")
    for _ in range(2):
        tables.write_lookups(spark, Lookups.fixed(), "lookup_db")
    assert spark.table("lookup_db.outcome_limit").count() == 49
    assert spark.table("lookup_db.term_durations").count() == 7


def test_episodes_overwrite_and_append(spark):
    episodes = EpisodePlan(cdm(spark, [(1, "LB", 400), (1, "UP", 200)]), codes(spark)).episodes
    for _ in range(2):
        tables.write_episodes(episodes, "episodes_out")
    assert tables.read_episodes(spark, "episodes_out").count() == 1
    tables.write_episodes(episodes, "episodes_out", mode="append")
    stored = tables.read_episodes(spark, "episodes_out")
    assert stored.count() == 2
    assert [(f.name, f.dataType.simpleString()) for f in stored.schema] == list(tables.EPISODE_COLUMNS)


def test_new_result_table_is_empty(spark):
    tables.create_episodes(spark, "episodes_new")
    assert tables.read_episodes(spark, "episodes_new").count() == 0
    episodes = EpisodePlan(cdm(spark, [(1, "LB", 400), (1, "UP", 200)]), codes(spark)).episodes
    tables.write_episodes(episodes, "episodes_new", mode="append")
    assert tables.read_episodes(spark, "episodes_new").count() == 1


def test_large_lookups_are_refused(spark, tmp_path):
    fixed = Lookups.fixed().tables(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS large_db")
    tables.write_lookups(spark, Lookups.fixed(), "large_db")
    copies = fixed["gest_est"].crossJoin(spark.range(200)).drop("id")
    copies.write.mode("overwrite").saveAsTable("large_db.gest_est")
    with pytest.raises(ValueError):
        Lookups.from_tables(spark, "large_db")


def test_csv_sink(spark, tmp_path):
    episodes = EpisodePlan(cdm(spark, [(1, "LB", 400), (1, "UP", 200)]), codes(spark)).episodes
    path = str(tmp_path / "counts")
    tables.write_csv(su.outcome_counts(episodes), path)
    back = spark.read.option("header", True).csv(path).collect()
    assert [tuple(r) for r in back] == [("LB", "1")]


def test_parquet_and_catalog_sources_agree(spark, tmp_path):
    base = cdm(spark, [(1, "LB", 400), (1, "UP", 200), (2, "SB", 5), (2, "LMP", -100)])
    spark.sql("CREATE DATABASE IF NOT EXISTS cdm_db")
    for f in fields(Cdm):
        getattr(base, f.name).write.mode("overwrite").parquet(str(tmp_path / f.name))
        getattr(base, f.name).write.mode("overwrite").saveAsTable(f"cdm_db.{f.name}")
    runs = [
        sorted(EpisodePlan(source, codes(spark)).episodes.collect())
        for source in (base, Cdm.from_parquet(spark, str(tmp_path)), Cdm.from_catalog(spark, "cdm_db"))
    ]
    assert runs[0] == runs[1] == runs[2]
    assert len(runs[0]) == 2


def test_one_scan_of_the_facts_equals_the_union_of_tables(spark):
    facts = fixture_cdm(spark, SF)
    apart = Cdm(**{f.name: getattr(facts, f.name) for f in fields(Cdm)})
    one, many = facts.all_records(), apart.all_records().select(facts.all_records().columns)
    assert one.exceptAll(many).count() == 0
    assert many.exceptAll(one).count() == 0
    split = EpisodePlan(apart, code_set(spark)).episodes
    assert sorted(split.collect()) == sorted(EpisodePlan(facts, code_set(spark)).episodes.collect())


def test_dirty_numbers_become_null(spark):
    base = cdm(spark, [(1, "LB", 0)])
    parts = {f.name: getattr(base, f.name) for f in fields(Cdm)}
    parts["observation"] = spark.sql(
        "SELECT 1L AS person_id, 16 AS observation_concept_id, DATE '2000-01-01' AS observation_date, "
        "' ' AS value_as_string, 'ten' AS value_as_number"
    )
    assert Cdm(**parts).observations().first().value_as_number is None


def test_cut_lineage_keeps_rows(spark):
    table = spark.range(10)
    assert sorted(tables.cut_lineage(table).collect()) == sorted(table.collect())


@pytest.mark.parametrize("store", [False, True])
def test_stored_events_give_the_same_episodes(spark, store):
    plan = EpisodePlan(fixture_cdm(spark, SF), code_set(spark), store_events=store)
    assert plan.episodes.count() == 438
