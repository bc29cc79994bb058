"""Episodes inside observation periods: every way in which they lie to each other, and a person with many of both."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from natalis.operators import episodes as ep
from tests.clinic import date

EPISODES = "person_id long, end_day int, start_day int, category string"
PERIODS = "person_id long, observation_period_start_date date, observation_period_end_date date"


def held(episodes, periods):
    """Episodes and the number of periods that hold them, by comparing each with each."""
    out = Counter()
    for p, end, start, category in episodes:
        n = sum(p == q and None not in (a, b, start) and a <= start and a <= end <= b for q, a, b in periods)
        if n:
            out[(p, end, start, category, n)] += 1
    return out


def found(spark, episodes, periods):
    dated = [(p, None if a is None else date(a), None if b is None else date(b)) for p, a, b in periods]
    rows = ep.within_enrolment(spark.createDataFrame(episodes, EPISODES), spark.createDataFrame(dated, PERIODS))
    return Counter((r.person_id, r.end_day, r.start_day, r.category, r.n) for r in rows.collect())


@pytest.mark.parametrize("seed", range(4))
def test_episodes_and_periods_at_random(spark, seed):
    """Overlapping and nested episodes, periods of no length and turned ones, copies, equal edges."""
    rng = random.Random(seed)
    episodes, periods = [], []
    for p in range(60):
        ends = rng.sample(range(40), rng.randrange(0, 7))
        episodes += [(p, e, rng.choice([e - rng.randrange(0, 25), e, e + 2]), rng.choice("xy")) for e in ends]
        periods += [(p, a, a + rng.randrange(-3, 40)) for a in rng.choices(range(-10, 40), k=rng.randrange(0, 12))] * rng.choice([1, 1, 2])
    periods += [(3, None, 50), (3, -50, None), (99, -50, 50)]
    episodes += [(4, 41, None, "x")]
    assert found(spark, episodes, periods) == held(episodes, periods) and held(episodes, periods)


def test_no_rows(spark):
    assert not found(spark, [], [(1, 0, 9)]) and not found(spark, [(1, 5, 2, "x")], [])


def test_many_periods_of_one_person(spark):
    """1,000 episodes in 100,000 periods: no join, and rows in proportion to both."""
    episodes = spark.range(1000).select(F.lit(7).cast("long").alias("person_id"), (F.col("id") * 60 + 50).cast("int").alias("end_day"), (F.col("id") * 60).cast("int").alias("start_day"), F.lit("x").alias("category"))
    first = F.col("id").cast("int") % 59_000
    days = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), c)
    periods = spark.range(100_000).select(F.lit(7).cast("long").alias("person_id"), days(first).alias("observation_period_start_date"), days(first + 200 + (F.col("id") % 7).cast("int")).alias("observation_period_end_date"))
    rows = ep.within_enrolment(episodes, periods)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text
    got = {r.start_day // 60: r.n for r in rows.collect()}
    starts = Counter((k % 59_000, k % 59_000 + 200 + k % 7) for k in range(100_000))
    for k in (0, 1, 5, 500, 982):
        assert got[k] == sum(n for (a, b), n in starts.items() if a <= 60 * k and b >= 60 * k + 50)
