"""Tables made from finished episodes."""

import datetime as dt

from natalis.operators import summaries as su


def episodes(spark, rows):
    """Rows of (person, outcome, length, episode, start year)."""
    full = [
        (p, dt.date(y, 1, 1), dt.date(y, 1, 1) + dt.timedelta(days=n - 1), "LMP", o, e, o, n)
        for p, o, n, e, y in rows
    ]
    return spark.createDataFrame(
        full,
        "person_id long, episode_start_date date, episode_end_date date, start_method string, "
        "original_outcome string, episode long, outcome string, episode_length int",
    )


def test_length_histogram(spark):
    lengths = [-5, 0, 1, 9, 10, 309, 310]
    rows = [(i, "LB", n, 1, 2000) for i, n in enumerate(lengths)]
    rows += [(20, "SB", 280, 1, 2000), (21, "DELIV", 280, 1, 1986), (22, "DELIV", 280, 1, 2014), (23, "DELIV", 280, 1, 2013)]
    found = {(r.week, r.n) for r in su.length_histogram(episodes(spark, rows)).collect()}
    assert found == {(None, 1), (0, 2), (1, 1), (30, 1), (28, 1)}


def test_counts(spark):
    table = episodes(spark, [(1, "LB", 280, 1, 2000), (1, "SA", 60, 2, 2001), (2, "LB", 280, 1, 2000)])
    assert {tuple(r) for r in su.episodes_per_person(table).collect()} == {(2, 1), (1, 1)}
    assert {tuple(r) for r in su.outcome_counts(table).collect()} == {("LB", 2), ("SA", 1)}


def test_mother_table(spark):
    rows = [(i // 3, o, 100, i % 3 + 1, 2000) for i, o in enumerate(["SA", "DELIV", "AB", "ECT", "LB", "SB", "XX"])]
    found = sorted(su.mother_table(episodes(spark, rows)).collect(), key=lambda r: r.pregnancy_id)
    assert [r.pregnancy_id for r in found] == list(range(1, 8))
    assert [r.original_outcome for r in found] == [4067106, 4092289, 4081422, 4081422, 4092289, 4067106, 0]
    assert [r.prev_pregnancy_gravidity for r in found] == [0, 1, 2, 0, 1, 2, 0]
    assert all(r.pregnancy_single is None and r.pregnancy_mode_delivery is None for r in found)


def test_numbers_do_not_depend_on_the_partitions(spark):
    table = episodes(spark, [(p * 37 % 101, "LB", 280, 1, 2000) for p in range(100)]).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    try:
        for partitions in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            numbered = su.add_global_number(table, "number", "person_id", "episode")
            runs.append(sorted((r.person_id, r.number) for r in numbered.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert runs[0] == runs[1] == runs[2]
    assert [n for _, n in runs[0]] == list(range(1, 101))


def test_empty_episodes(spark):
    assert su.mother_table(episodes(spark, [])).count() == 0
