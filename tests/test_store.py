"""What stored tables and early filters spare a run, with equal results."""

import pytest
from pyspark.sql import functions as F

from natalis import Cdm, EpisodePlan
from natalis.operators import events as ev
from natalis.operators import prefilter
from natalis.plans.catalogue import QUERIES
from natalis.sources.cdm import MOST_RANGES, covering, within
from natalis.sources.fixtures import code_set, fixture_cdm, split_cdm
from natalis.sources.store import read_events, write_events, write_records
from tests.clinic import cdm, codes

SF = "/root/testdata/sf0.001"


def plan_text(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many_files(spark):
    """As many files and partitions as asked for, however small."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows_read(table):
    """The rows that the table's scans put out."""
    table.collect()
    leaves = table._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_ranges_cover_all_ids():
    assert covering([]) == []
    assert covering([5, 5, 5]) == [(5, 5)]
    assert covering([1, 2, 3, 10, 11, 1000], 2) == [(1, 11), (1000, 1000)]
    assert covering([1, 2, 3]) == [(1, 3)]
    ids = [k * k for k in range(100)]
    found = covering(ids)
    assert len(found) == MOST_RANGES and all(any(a <= i <= b for a, b in found) for i in ids)


def test_no_range_reads_no_row(spark):
    table = spark.range(10).select(F.col("id").cast("int").alias("c"), F.col("id").cast("string").alias("s"))
    assert within(table, "c", []).count() == 0
    assert within(table, "c", None).count() == 10
    assert sorted(r.c for r in within(table, "c", [(2, 4), (7, 7)]).collect()) == [2, 3, 4, 7]
    assert within(table, "s", [(2, 4)]).count() == 10  # ids that are no numbers are not compared


def test_large_sets_of_codes_give_one_range(spark, monkeypatch):
    table = spark.range(40).select((F.col("id") % 2 == 0).alias("for_drug"), F.col("id").cast("int").alias("concept_id"))
    assert ev.id_ranges(table, "for_drug")[True][0][0] == 0
    monkeypatch.setattr(ev, "BROADCAST_ROWS", 5)
    assert ev.id_ranges(table, "for_drug") == {True: [(0, 38)], False: [(1, 39)]}


def test_scans_skip_unlisted_concepts(spark, tmp_path, many_files):
    write_records(split_cdm(spark, SF), str(tmp_path))
    stored = Cdm.from_parquet(spark, str(tmp_path))
    total = stored.condition_occurrence.count()
    few = stored.conditions([(9, 9)])
    assert few.count() == stored.condition_occurrence.filter("condition_concept_id = 9").count() > 0
    assert rows_read(stored.conditions([(9, 9)])) < total / 4
    coded = ev.coded_records(stored, code_set(spark))
    text = plan_text(coded)
    assert "PushedFilters: [Or(" in text or "GreaterThanOrEqual(condition_concept_id,0)" in text
    assert "LessThanOrEqual(condition_concept_id,31)" in text  # 32 to 39 are not listed
    assert sorted(EpisodePlan(stored, code_set(spark)).episodes.collect()) == sorted(QUERIES["episodes_final"](spark, SF).collect())


def test_hierarchy_is_read_below_listed_ancestors(spark, tmp_path, many_files):
    write_records(split_cdm(spark, SF), str(tmp_path))
    stored = Cdm.from_parquet(spark, str(tmp_path))
    listed = ev.drug_codes(stored, code_set(spark), [(101, 103)])
    assert "GreaterThanOrEqual(ancestor_concept_id,101)" in plan_text(listed)
    every = ev.drug_codes(stored, code_set(spark))
    assert sorted(listed.collect()) == sorted(every.collect())


def test_second_run_from_stored_events_does_not_shuffle_by_person(spark):
    first = EpisodePlan(fixture_cdm(spark, SF), code_set(spark))
    for _ in range(2):  # the second one replaces the first
        write_events(first.counted, "events_by_person", 4)
    second = EpisodePlan(first.cdm, first.codes, stored_events=read_events(spark, "events_by_person"))
    text = plan_text(ev.clean_events(second.promising))
    assert "Exchange" not in text and "lineitem" not in text and "Bucketed: true" in text
    assert sorted(second.episodes.collect()) == sorted(first.episodes.collect())


def test_filter_holds_every_person(spark, monkeypatch):
    ids = [(i * 7919,) for i in range(3000)] + [(None,), (0,), (-5,)]
    persons = spark.createDataFrame(ids, "person_id long")
    others = spark.range(10**6, 10**6 + 20_000).select(F.col("id").alias("person_id")).filter("person_id % 7919 <> 0")
    records = persons.union(others)
    found = prefilter.of_persons(records, persons)
    assert found.join(persons.distinct(), "person_id").count() == persons.filter("person_id is not null").count()
    assert found.join(others, "person_id", "left_semi").count() < 0.2 * others.count()
    assert "Exchange hashpartitioning(person_id" not in plan_text(found)
    monkeypatch.setattr(prefilter, "MOST_WORDS", 8)  # too full to tell anyone apart, but no one is lost
    words, number = prefilter.person_filter(persons)
    assert number == 8 and words.count() <= 8
    assert prefilter.of_persons(records, persons).join(persons, "person_id", "left_semi").count() == 3002
    assert prefilter.of_persons(records, persons.limit(0)).count() == 0


def test_persons_without_outcome_leave_before_the_shuffle(spark):
    some = [(1, "LB", 400), (1, "UP", 200), (2, "SB", 50), (2, "LMP", -100)]
    idle = [(p, c, d) for p in range(100, 400) for c, d in (("UP", 5), ("LMP", 60), ("AGP", 90))]
    source = cdm(spark, some + idle)
    early, late = (EpisodePlan(source, codes(spark), early_persons=e) for e in (True, False))
    assert late.promising.count() == len(some) + len(idle)
    assert early.promising.count() < 0.3 * late.promising.count()
    assert sorted(early.episodes.collect()) == sorted(late.episodes.collect())
    assert sorted(early.kept.collect()) == sorted(late.kept.collect())


def test_no_outcome_at_all(spark):
    plan = EpisodePlan(cdm(spark, [(1, "UP", 5)]), codes(spark), early_persons=True)
    assert plan.promising.count() == 0 and plan.episodes.count() == 0
