"""What must hold whatever the size and spread of the data."""

import re
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from natalis import Cdm, EpisodePlan, Options
from natalis.operators import events as ev
from natalis.operators import outcomes as oc
from natalis.operators import temporal
from natalis.operators.temporal import COPIES_PER_CHUNK, expand_copies
from natalis.plans.catalogue import QUERIES
from natalis.sources.fixtures import code_set, fixture_cdm
from tests.clinic import Person, cdm, codes
from tests.test_property import random_events

SF = "/root/testdata/sf0.001"


def plan_text(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_queries_join_on_keys_and_stay_in_the_jvm(spark):
    for name, query in QUERIES.items():
        text = plan_text(query(spark, SF))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert node not in text, (name, node)


def test_scans_read_only_the_columns_used(spark):
    text = plan_text(QUERIES["episodes_final"](spark, SF))
    assert "l_extendedprice" not in text and "l_comment" not in text and "o_totalprice" not in text


def test_one_person_with_a_third_of_all_records(spark):
    rows = [r for r in random_events(60, seed=3)]
    hot = [(1000, "LB", 400), (1000, "UP", 200), (1000, "AB", 900), (1000, "SA", 905)]
    copied = rows + hot * (len(rows) // 8)
    plan = EpisodePlan(cdm(spark, copied), codes(spark))
    assert plan.counted.filter("person_id = 1000").count() == len(hot)
    played = Person([(c, d, None) for _, c, d in hot * (len(rows) // 8)])
    found = plan.outcomes.filter("person_id = 1000").select("event_id", "category", "end_day", "records")
    assert {tuple(r) for r in found.collect()} == {(i, c, d, played.records(i)) for i, c, d in played.outcomes()}
    numbers = ev.numbered_events(plan.events).filter("person_id = 1000").agg(
        F.count("*"), F.countDistinct("event_id"), F.min("event_id"), F.max("event_id")
    )
    total = len(hot) * (len(rows) // 8)
    assert tuple(numbers.first()) == (total, total, 1, total)


def test_copies_beyond_one_chunk(spark):
    n = 2 * COPIES_PER_CHUNK + 5
    rows = spark.sql(f"SELECT 1L AS person_id, 7L AS event_id, {n}L AS n UNION ALL SELECT 2L, 1L, 1L")
    found = expand_copies(rows, "event_id").groupBy("person_id").agg(
        F.count("*"), F.countDistinct("event_id"), F.min("event_id"), F.max("event_id")
    )
    assert {tuple(r) for r in found.collect()} == {(1, n, n, 7, n + 6), (2, 1, 1, 1, 1)}


def test_each_clinical_table_is_scanned_once(spark, tmp_path):
    source = fixture_cdm(spark, SF)
    names = [f.name for f in fields(Cdm)]
    for name in names:
        getattr(source, name).write.parquet(str(tmp_path / name))
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = EpisodePlan(Cdm.from_parquet(spark, str(tmp_path)), code_set(spark))
            cleaned, table = plan.cleaned, plan.episodes
            assert table.count() == 438
            cleaned.collect()
            final = plan_text(cleaned).split("== Initial Plan ==")[0]
            after = plan_text(table)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("condition", "procedure", "observation", "measurement", "drug"):
            assert len(re.findall(rf"FileScan parquet \[[^\]]*{name}_concept_id#", final)) == 1, name
            assert f"{name}_concept_id#" not in after, name


def test_final_episodes_read_stored_outcomes(spark):
    """What follows the outcomes neither codes records nor accepts outcomes again, and mother rows are numbered without a window."""
    table = QUERIES["episodes_final"](spark, SF)
    text = plan_text(table)
    assert len(re.findall(r"\bWindow \[", text)) <= 9 and "lineitem" not in text
    numbered = plan_text(QUERIES["mother_table"](spark, SF))
    assert "Window" not in numbered and "lambda" not in numbered


def episodes_of(spark, shuffle_input=False):
    source = fixture_cdm(spark, SF)
    if shuffle_input:
        parts = {f: getattr(source, f) for f in source.__dataclass_fields__}
        parts["facts"] = source.facts.repartition(13, F.rand(5))
        source = type(source)(**parts)
    return sorted(EpisodePlan(source, code_set(spark)).episodes.collect())


def test_result_does_not_depend_on_partitions_or_row_order(spark):
    expected = episodes_of(spark)
    assert len(expected) == 438
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert episodes_of(spark, shuffle_input=True) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_code_map_is_joined_by_shuffle(spark, monkeypatch):
    expected = episodes_of(spark)
    monkeypatch.setattr(ev, "broadcast_if_small", lambda table, **_: table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert episodes_of(spark) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["episodes_final", "episodes_final_intended"])
def test_accepted_outcomes_never_clash(spark, name):
    final = QUERIES[name](spark, SF)
    assert final.filter("episode_length < 1 OR episode_start_date > episode_end_date").count() == 0
    assert final.groupBy("person_id", "episode_end_date").count().filter("count > 1").count() == 0


def test_outcomes_of_one_person_are_walked_in_parts(spark, monkeypatch):
    """A person whose outcomes lie in runs apart: every run is walked by itself, and the first birth counts for all."""
    rows = [(1, c, 2000 * run + d) for run in range(30) for c, d in (("LB", 0), ("SB", 40), ("AB", 300), ("SA", 310), ("LB", 700), ("ECT", 900), ("MTX", 901))]
    rows += [(p, "LB", 400 * p) for p in range(2, 9)]
    walked = []
    whole = oc.greedy_accept
    monkeypatch.setattr(oc, "greedy_accept", lambda *a: walked.append(whole(*a)) or walked[-1])
    for options in (Options(), Options.intended()):
        plan = EpisodePlan(cdm(spark, rows), codes(spark), options=options)
        played = {p: Person([(c, d, None) for q, c, d in rows if q == p], lb_gap=options.lb_gap, sb_veto=options.sb_veto) for p in range(1, 9)}
        found = plan.outcomes.select("person_id", "event_id", "category", "end_day", "records").collect()
        assert {tuple(r) for r in found} == {(p, i, c, d, x.records(i)) for p, x in played.items() for i, c, d in x.outcomes()}
        assert plan.valid_outcomes.count() == len(found)
        parts = walked[-1].filter("person_id = 1")
        assert parts.count() == 30 and max(len(r.accepted) for r in parts.collect()) <= 7
        assert parts.select(F.spark_partition_id()).distinct().count() > 1


def test_events_are_dealt_to_more_tasks_as_they_grow(spark, monkeypatch):
    """No task by person has more rows than it may sort, and what is found stays the same."""
    expected = episodes_of(spark)
    rows = [(p, c, 300 * k + d) for p in range(120) for k in range(4) for c, d in (("LMP", 0), ("UP", 40), ("LB", 270))]
    monkeypatch.setattr(temporal, "ROWS_PER_TASK", 60)
    plan = EpisodePlan(cdm(spark, rows), codes(spark))
    assert plan.parts == len(rows) // 60
    for table in (plan.cleaned, plan.telling, plan.outcomes, plan.kept, plan.valid_outcomes, plan.dated):
        tasks = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) > spark.sparkContext.defaultParallelism and max(tasks) < 5 * 60
    assert episodes_of(spark) == expected
