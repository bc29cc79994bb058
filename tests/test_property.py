"""Random persons: the engine against the step-by-step play of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from natalis import EpisodePlan, Options
from tests.clinic import CATEGORIES, DAY0, Person, borrowed_prior, cdm, codes

WEIGHTS = [6 if c in ("LB", "SB", "DELIV", "ECT", "AB", "SA") else 3 if c.startswith("ECT_") else 2 for c in CATEGORIES]


def random_events(people, seed):
    rng = random.Random(seed)
    rows = []
    for person in range(1, people + 1):
        span = rng.choice((200, 500, 900, 2500))
        for _ in range(rng.randint(1, 45)):
            category = rng.choices(CATEGORIES, WEIGHTS)[0]
            weeks = rng.choice((None, 4, 10.5, 20, 30, 38, 43, 44)) if category == "GEST" else None
            rows.append((person, category, rng.randint(0, span), weeks))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("options", [Options(), Options.intended()], ids=["written", "intended"])
def test_random_persons(spark, options):
    rows = random_events(600, seed=7)
    by_person = {}
    for person, category, day, weeks in rows:
        by_person.setdefault(person, []).append((category, day, weeks))
    people = {
        p: Person(events, lb_gap=options.lb_gap, sb_veto=options.sb_veto) for p, events in by_person.items()
    }
    plan = EpisodePlan(cdm(spark, rows), codes(spark), options=options)

    outcomes = plan.outcomes.select("person_id", "event_id", "category", "end_day", "records").collect()
    expected = {(p, i, c, d, x.records(i)) for p, x in people.items() for i, c, d in x.outcomes()}
    assert {tuple(r) for r in outcomes} == expected
    assert len(outcomes) == len(expected)

    def ovul2(i):
        return "own" if options.ovul2_join == "person" else borrowed_prior(people, i)

    starts = plan.dated.select("person_id", "event_id", F.inline("starts")).collect()
    found = {(r.person_id, r.event_id, r.start_category, r.start_day) for r in starts}
    assert found == {
        (p, i, name, day)
        for p, x in people.items()
        for i in x.valid
        for name, day in x.starts(i, ovul2(i)).items()
        if name not in ("PUSHBACK", "CONTRA")
    }

    final = plan.episodes.collect()
    got = {
        (r.person_id, (r.episode_end_date.toordinal() - 719163), r.start_method, r.episode_start_date.toordinal() - 719163)
        for r in final
    }
    wanted = set()
    for p, x in people.items():
        for i in x.valid:
            name, start = x.chosen(i, ovul2(i))
            if x.records(i) >= 2:
                wanted.add((p, x.events[i][1], name, start))
    assert got == wanted
    assert all(r.episode_length >= 1 for r in final)
    assert min(r.episode_end_date.toordinal() - 719163 for r in final) >= DAY0
