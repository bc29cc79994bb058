"""Each rule at its edges, on persons made for the purpose."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from natalis import EpisodePlan, Options
from natalis.functions.classify import outcome_class
from natalis.functions.days import ceil_day, floor_day, gestation_start_micros
from natalis.lookups import values
from natalis.operators import episodes as ep
from natalis.operators import events as ev
from natalis.operators import starts as st
from tests.clinic import DAY0, cdm, codes, date

# name: (events as (category, day), accepted as (category, day))
WRITTEN = {
    "stillbirth with care on its day": ([("SB", 100), ("AGP", 100)], []),
    "stillbirth with care 41 days before": ([("SB", 100), ("PCONF", 59)], []),
    "stillbirth with care 42 days before": ([("SB", 100), ("AGP", 58)], [("SB", 100)]),
    "stillbirth with care after": ([("SB", 100), ("AGP", 101)], [("SB", 100)]),
    "delivery with care on its day": ([("DELIV", 100), ("AGP", 100)], [("DELIV", 100)]),
    "delivery with care a day after": ([("DELIV", 100), ("AGP", 101)], []),
    "delivery with care 42 days after": ([("DELIV", 100), ("PCONF", 142)], []),
    "delivery with care 43 days after": ([("DELIV", 100), ("PCONF", 143)], [("DELIV", 100)]),
    "ectopic without proof": ([("ECT", 100)], []),
    "ectopic with second surgery stays": ([("ECT", 100), ("ECT_SURG2", 114)], [("ECT", 100)]),
    "ectopic with drug moves": ([("ECT", 100), ("MTX", 114), ("MTX", 105)], [("ECT", 114)]),
    "ectopic with drug too late": ([("ECT", 100), ("MTX", 115)], []),
    "ectopic with drug before": ([("ECT", 100), ("MTX", 99)], []),
    "ectopic, care counted from the moved day": ([("ECT", 100), ("MTX", 110), ("AGP", 152)], []),
    "ectopic, care beyond the moved day": ([("ECT", 100), ("MTX", 110), ("AGP", 153)], [("ECT", 110)]),
    "ectopic, care between the two days": ([("ECT", 100), ("MTX", 110), ("AGP", 105)], [("ECT", 110)]),
    "loss moves to the last in 14 days": ([("AB", 100), ("SA", 114)], [("AB", 114)]),
    "loss stays beyond 14 days": ([("AB", 100), ("SA", 115)], [("AB", 100)]),
    "losses move one step each": ([("AB", 100), ("AB", 110), ("AB", 120)], [("AB", 110)]),
    "losses of one kind see moved ones": ([("SA", 100), ("AB", 113), ("SA", 125)], [("AB", 125)]),
    "copies of a moved loss stay": ([("AB", 100), ("AB", 100), ("SA", 110)], [("AB", 110)]),
    "stillbirth 166 days after a birth": ([("LB", 0), ("SB", 166)], [("LB", 0)]),
    "stillbirth 167 days after a birth": ([("LB", 0), ("SB", 167)], [("LB", 0), ("SB", 167)]),
    "stillbirth 182 days before a birth": ([("SB", 0), ("LB", 182)], [("LB", 182)]),
    "stillbirth 183 days before a birth": ([("SB", 0), ("LB", 183)], [("SB", 0), ("LB", 183)]),
    "one live birth only": ([("LB", 0), ("LB", 900)], [("LB", 0)]),
    "trophoblastic disease is never accepted": ([("TRO", 0)], []),
    "rejected candidates do not block": (
        [("LB", 0), ("SB", 100), ("SB", 200)],
        [("LB", 0), ("SB", 200)],
    ),
}
FORWARD = {
    "births 180 days apart": ([("LB", 0), ("LB", 180)], [("LB", 0)]),
    "births 181 days apart": ([("LB", 0), ("LB", 181)], [("LB", 0), ("LB", 181)]),
    "gap counts from the last accepted birth": (
        [("LB", 0), ("LB", 150), ("LB", 200), ("LB", 390)],
        [("LB", 0), ("LB", 200), ("LB", 390)],
    ),
    "stillbirth with care before": ([("SB", 100), ("AGP", 90)], [("SB", 100)]),
    "stillbirth with care after": ([("SB", 100), ("AGP", 142)], []),
}


@pytest.mark.parametrize(
    "cases, options", [(WRITTEN, Options()), (FORWARD, Options.intended())], ids=["written", "intended"]
)
def test_accepted_outcomes(spark, cases, options):
    rows = [(p, c, d) for p, (events, _) in enumerate(cases.values(), 1) for c, d in events]
    outcomes = EpisodePlan(cdm(spark, rows), codes(spark), options=options).outcomes.collect()
    for p, (name, (_, expected)) in enumerate(cases.items(), 1):
        found = sorted((r.category, r.end_day - DAY0) for r in outcomes if r.person_id == p)
        assert found == sorted(expected), name


def test_options_are_checked():
    with pytest.raises(ValueError):
        Options(lb_gap="sideways")


REFINED = [
    # best, push, stop, refined
    (100, None, None, 100),
    (100, 90, None, 90),
    (100, 110, None, 100),
    (100, None, 105, 105),
    (100, None, 95, 100),
    (100, 90, 80, 90),
    (100, 90, 95, 95),
    (100, 90, 90, 100),
    (100, 110, 105, 105),
    (100, 110, 95, 100),
    (100, 100, 105, 100),
]


def test_refined_start(spark):
    rows = values(
        spark, [(i, *r[:3]) for i, r in enumerate(REFINED)], "i int, b int, pushback_start int, contra_start int"
    )
    found = (
        rows.withColumn("best", F.struct(F.col("b").alias("start_day")))
        .select("i", st.refined_day().alias("day"))
        .collect()
    )
    assert [r.day for r in sorted(found)] == [r[3] for r in REFINED]


def test_gestation_bounds_and_fractions(spark):
    rows = [(1, "GEST", 0, 43), (2, "GEST", 0, 43.1), (3, "GEST", 0, None), (4, "GEST", 0, 10 + 1 / 7)]
    plan = EpisodePlan(cdm(spark, rows), codes(spark))
    events = {r.person_id: r for r in plan.events.collect()}
    assert set(events) == {1, 4}
    micros = gestation_start_micros(F.col("day"), F.col("gest_value"))
    start = plan.events.filter("person_id = 4").select(floor_day(micros), ceil_day(micros)).first()
    assert tuple(start) == (DAY0 - 71 + 1, DAY0 - 71 + 1)
    half = spark.sql("SELECT 100 AS day, CAST(10.5 AS DECIMAL(24,12)) AS gest_value")
    assert tuple(half.select(floor_day(micros), ceil_day(micros)).first()) == (90, 91)


def test_latest_gestation_record_wins_ties_by_smallest_value(spark):
    rows = [(1, "LB", 300), (1, "GEST", 200, 30), (1, "GEST", 200, 28), (1, "GEST", 150, 20)]
    dated = EpisodePlan(cdm(spark, rows), codes(spark)).dated.first()
    assert dated.gest_start - DAY0 == 200 - 28 * 7 + 1


def test_glucose_only_persons_leave(spark):
    rows = [(1, "DIAB", 0), (1, "DIAB", 5), (2, "DIAB", 0), (2, "LB", 10), (3, "DIAB", 0), (3, "GEST", 1, None)]
    events = EpisodePlan(cdm(spark, rows), codes(spark)).events
    assert {r.person_id for r in events.collect()} == {2, 3}


def test_codes_without_category_are_dropped(spark):
    extra = values(spark, [(7, None, None, "N/A")], "concept_id int, category string, gest_value int, data_value string")
    # Concept 7 is SA in the code set; the extra code maps it to no category as well.
    plan = EpisodePlan(cdm(spark, [(1, "SA", 0)]), codes(spark).union(extra))
    assert [(r.category, r.n) for r in plan.events.collect()] == [("SA", 1)]


def test_a_concept_listed_twice_counts_twice(spark):
    twice = values(spark, [(1, "LB", None, "N/A")], "concept_id int, category string, gest_value int, data_value string")
    plan = EpisodePlan(cdm(spark, [(1, "LB", 0)]), codes(spark).union(twice))
    assert plan.events.select("n", "event_id").collect() == [(2, 1)]
    assert plan.episodes.count() == 1


def test_drugs_follow_the_hierarchy(spark):
    listed = "concept_id int, category string, gest_value int, data_value string"
    code_set = codes(spark).union(values(spark, [(500, "MTX", 3, "N/A"), (501, "CONTRA", None, "N/A")], listed))
    base = cdm(spark, [(1, "LB", 0)], drugs=[(1, 900, date(DAY0)), (1, 901, date(DAY0)), (9, 900, date(DAY0))])
    tables = {f: getattr(base, f) for f in base.__dataclass_fields__}
    tables["concept"] = spark.createDataFrame(
        [(900, "a", "Ingredient"), (901, "b", "Dose Form")],
        "concept_id int, concept_name string, concept_class_id string",
    )
    tables["concept_ancestor"] = spark.createDataFrame(
        [(500, 900), (501, 900), (500, 901)], "ancestor_concept_id int, descendant_concept_id int"
    )
    events = EpisodePlan(type(base)(**tables), code_set).events.collect()
    assert sorted((r.person_id, r.category, r.gest_value and int(r.gest_value)) for r in events) == [
        (1, "CONTRA", None),
        (1, "LB", None),
        (1, "MTX", 3),
    ]


def test_recorded_values_narrow_observations_only(spark):
    listed = "concept_id int, category string, gest_value int, data_value string"
    code_set = values(spark, [(1, "FT", None, "R"), (2, "LB", None, "N/A")], listed)
    base = cdm(spark, [(1, "LB", 0)])
    tables = {f: getattr(base, f) for f in base.__dataclass_fields__}
    observed = [(1, 1, date(DAY0), v, None) for v in ("R", "N", None)] + [(1, 2, date(DAY0), "x", None)]
    tables["observation"] = spark.createDataFrame(observed, base.observation.schema)
    tables["condition_occurrence"] = spark.createDataFrame([(1, 1, date(DAY0))], base.condition_occurrence.schema)
    records = type(base)(**tables).clinical_records()
    coded = ev.map_codes(records, ev.code_map(type(base)(**tables), code_set))
    assert sorted((r.type, r.category, r.value_as_string) for r in coded.collect()) == [
        ("Cond", "FT", " "),
        ("Obs", "FT", "R"),
        ("Obs", "LB", "x"),
    ]


def chosen(spark, rows):
    return values(
        spark,
        [(p, "LB", end, 5, "LMP", start) for p, start, end in rows],
        "person_id bigint, category string, end_day int, records bigint, start_category string, start_day int",
    )


def test_enrolment_edges_and_numbering(spark):
    day = (dt.date(2000, 3, 1) - dt.date(1970, 1, 1)).days
    rows = [(1, day, day + 200), (2, day - 1, day + 200), (3, day, day + 301), (4, day, day + 200), (4, day + 220, day + 300)]
    periods = [(p, date(day), date(day + 300)) for p in (1, 2, 3)]
    periods += [(4, date(day), date(day + 300)), (4, date(day), date(day + 300)), (4, date(day - 9), date(day + 250))]
    base = cdm(spark, [(1, "LB", 0)], persons=[(p, 8532, 1975) for p in range(1, 5)], periods=periods)
    found = ep.eligible_episodes(chosen(spark, rows), base.observation_period, base.person, Options())
    got = sorted((r.person_id, r.start_day - day, r.episode) for r in found.collect())
    assert got == [(1, 0, 1), (4, 0, 1), (4, 0, 2), (4, 0, 3), (4, 220, 4), (4, 220, 5)]


def test_sex_and_age_limits(spark):
    day = (dt.date(2000, 6, 1) - dt.date(1970, 1, 1)).days
    persons = [(1, 8532, 1989), (2, 8532, 1988), (3, 8532, 1945), (4, 8532, 1944), (5, 8507, 1975)]
    person = spark.createDataFrame(persons, "person_id long, gender_concept_id int, year_of_birth int")
    rows = chosen(spark, [(p, day, day + 200) for p in range(1, 6)])
    assert {r.person_id for r in ep.of_women_of_age(rows, person, Options()).collect()} == {2, 3}


def test_two_records_are_needed(spark):
    rows = [
        (1, "LB", 400),  # alone
        (2, "LB", 400), (2, "UP", 100),  # 300 days before: inside
        (3, "LB", 400), (3, "UP", 99),  # 301 days before: outside
        (4, "LB", 400), (4, "LB", 400),  # a copy counts
        (5, "LB", 400), (5, "UP", 401),  # after: outside
    ]
    final = EpisodePlan(cdm(spark, rows), codes(spark)).episodes.collect()
    assert {r.person_id for r in final} == {2, 4}


def test_outcome_class(spark):
    rows = [("AB", 200, "SA/AB"), ("SA", 10, "SA/AB"), ("LB", 1, "LB/DELIV"), ("DELIV", 1, "LB/DELIV")]
    rows += [("SB", 139, "SA/AB"), ("SB", 140, "SB"), ("ECT", 50, "ECT")]
    table = spark.createDataFrame(rows, "c string, n int, wanted string")
    assert table.filter(outcome_class(F.col("c"), F.col("n")) != F.col("wanted")).count() == 0
