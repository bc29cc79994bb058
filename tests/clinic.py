"""Hand-made clinical tables, and the rules played out step by step in plain Python."""

from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction

from natalis.functions.classify import OUTCOMES, TARGETS
from natalis.lookups import Lookups, values
from natalis.sources.cdm import Cdm

CATEGORIES = (
    "LB SB DELIV TRO ECT AB SA AGP PCONF PCOMP TA ECT_SURG1 ECT_SURG2 MTX LMP GEST OVUL OVUL2 NULS AFP "
    "AMEN UP PREM POSTT FT DIAB CONTRA"
).split()
CONCEPT = {category: i for i, category in enumerate(CATEGORIES, 1)}
EPOCH = dt.date(1970, 1, 1)
DAY0 = (dt.date(2000, 1, 1) - EPOCH).days
L = Lookups.fixed()


def date(day: int) -> dt.date:
    return EPOCH + dt.timedelta(days=day)


def codes(spark):
    rows = [(i, category, None, "N/A") for category, i in CONCEPT.items()]
    return values(spark, rows, "concept_id int, category string, gest_value int, data_value string")


def frame(spark, rows, schema):
    rows = list(rows)
    return spark.createDataFrame(rows, schema)


def cdm(spark, events, persons=None, periods=None, drugs=()):
    """Clinical tables holding ``events``: (person, category, day[, weeks])."""
    events = [e if len(e) == 4 else (*e, None) for e in events]
    ids = sorted({e[0] for e in events})
    persons = persons or [(p, 8532, 1975) for p in ids]
    periods = periods or [(p, date(DAY0 - 9000), date(DAY0 + 9000)) for p in ids]
    observed = [(p, CONCEPT[c], date(DAY0 + d), " ", None if w is None else float(w)) for p, c, d, w in events]
    return Cdm(
        condition_occurrence=frame(
            spark, [], "person_id long, condition_concept_id int, condition_start_date date"
        ),
        procedure_occurrence=frame(spark, [], "person_id long, procedure_concept_id int, procedure_date date"),
        observation=frame(
            spark,
            observed,
            "person_id long, observation_concept_id int, observation_date date, "
            "value_as_string string, value_as_number double",
        ),
        measurement=frame(
            spark,
            [],
            "person_id long, measurement_concept_id int, measurement_date date, "
            "value_source_value string, value_as_number double",
        ),
        drug_exposure=frame(
            spark, drugs, "person_id long, drug_concept_id int, drug_exposure_start_date date"
        ),
        concept=frame(spark, [], "concept_id int, concept_name string, concept_class_id string"),
        concept_ancestor=frame(spark, [], "ancestor_concept_id int, descendant_concept_id int"),
        observation_period=frame(
            spark,
            periods,
            "person_id long, observation_period_start_date date, observation_period_end_date date",
        ),
        person=frame(spark, persons, "person_id long, gender_concept_id int, year_of_birth int"),
    )


class Person:
    """One person's events, worked through round by round."""

    def __init__(self, events, lb_gap="as_written", sb_veto="back"):
        kept = []
        for category, day, weeks in events:
            gest = Fraction(7 * weeks) if category == "GEST" and weeks is not None else None
            if category == "GEST" and (gest is None or gest > 301):
                continue
            kept.append([category, DAY0 + day, gest])
        kept.sort(key=lambda e: (e[1], e[0], e[2] is not None, e[2] or 0))
        if {e[0] for e in events} == {"DIAB"}:
            kept = []
        self.events = {i: e for i, e in enumerate(kept, 1)}
        self.valid = []
        self.lb_gap, self.sb_veto = lb_gap, sb_veto
        for target in TARGETS:
            self._step(target)

    def _near(self, categories, day, lo, hi):
        return [d for c, d, _ in self.events.values() if c in categories and lo <= d - day <= hi]

    def _step(self, target):
        seen, pool = set(), []
        for i, (category, day, gest) in self.events.items():
            if category in OUTCOMES and (category, day, gest) not in seen:
                seen.add((category, day, gest))
                pool.append(i)
        while True:
            mine = [i for i in pool if self.events[i][0] == target]
            if not mine:
                return
            first = min(mine, key=lambda i: (self.events[i][1], i))
            if target == "LB":
                self.valid.append(first)
                pool = [i for i in pool if not self._removed(first, i)]
                continue
            if self._passes(target, first):
                self.valid.append(first)
            pool.remove(first)

    def _removed(self, first, other):
        gap = self.events[first][1] - self.events[other][1]
        if self.lb_gap == "forward":
            gap = -gap
        return gap + 1 < L.min_days["LB", self.events[other][0]]

    def _passes(self, target, i):
        ok = True
        day = self.events[i][1]
        if target == "ECT":
            ok = bool(self._near(("ECT_SURG1", "ECT_SURG2", "MTX"), day, 0, 14))
            moved = self._near(("ECT_SURG1", "MTX"), day, 0, 14)
            if moved:
                self.events[i][1] = max(moved)
        if target in ("AB", "SA"):
            self.events[i][1] = max(self._near(("SA", "AB"), day, 0, 14))
        day = self.events[i][1]
        if target == "SB" and self.sb_veto == "back":
            cared = self._near(("AGP", "PCONF"), day, -41, 0)
        else:
            cared = self._near(("AGP", "PCONF"), day, 1, 42)
        return ok and not cared and not any(self._clash(j, i) for j in self.valid)

    def _clash(self, j, i):
        (a, a_day, _), (c, c_day, _) = self.events[j], self.events[i]
        limit = L.min_days[a, c] if a_day <= c_day else L.min_days[c, a]
        return abs(c_day - a_day + 1) < limit

    def outcomes(self):
        return sorted((i, self.events[i][0], self.events[i][1]) for i in self.valid)

    def prior(self, i):
        day = self.events[i][1]
        before = [(self.events[j][1], self.events[j][0]) for j in self.valid if self.events[j][1] < day]
        return max(before) if before else (None, None)

    def starts(self, i, ovul2_prior="own"):
        """Start day by rule for outcome ``i``; ``ovul2_prior`` is a day, None, or False for no match."""
        category, end, _ = self.events[i]
        prior, prior_category = self.prior(i)

        def window(before):
            lo = end - L.max_term[category]
            if before is not None:
                lo = max(lo, before + L.retry[category])
            return lo, end - L.min_term[category]

        def pick(categories, start, best, before=prior):
            lo, hi = window(before)
            found = [
                (d, -(g or 0), start(d, g))
                for c, d, g in self.events.values()
                if c in categories and lo <= start(d, g) <= hi
            ]
            return math.floor(best(found)[2]) if found else None

        def shift(days):
            return lambda d, g: d - days

        found = {
            "LMP": pick(("LMP",), shift(0), max),
            "GEST": pick(("GEST",), lambda d, g: d - g + 1, max),
            "OVUL": pick(("OVUL",), shift(13), min),
            "NULS": pick(("NULS",), shift(89), min),
            "AFP": pick(("AFP",), shift(123), min),
            "AMEN": pick(("AMEN",), shift(55), min),
            "UP": pick(("UP",), shift(55), min),
            "PUSHBACK": pick(("PCONF", "AGP", "PCOMP", "TA"), shift(55), min),
            "CONTRA": pick(("CONTRA",), shift(0), max),
        }
        if ovul2_prior is not False:
            before = prior if ovul2_prior == "own" else ovul2_prior
            found["OVUL2"] = pick(("OVUL2",), shift(13), min, before)
        since = end - L.max_term[category]
        if prior is not None:
            since = max(since, prior)
        remarks = {c for c, d, _ in self.events.values() if since <= d <= end + 30}
        days = L.nodata[category]
        if "FT" in remarks:
            days = L.fullterm[category]
        if "PREM" in remarks:
            days = L.preterm[category]
        default = end - days
        if prior is not None:
            default = max(default, prior + L.retry[prior_category])
        found["PREM" if "PREM" in remarks else "DEFAULT"] = default
        return {name: day for name, day in found.items() if day is not None}

    RANKS = {"LMP": 1, "GEST": 2, "OVUL": 3, "OVUL2": 4, "NULS": 6, "AFP": 7, "AMEN": 80, "UP": 90}

    def chosen(self, i, ovul2_prior="own"):
        found = self.starts(i, ovul2_prior)
        push, stop = found.pop("PUSHBACK", None), found.pop("CONTRA", None)
        name = min(found, key=lambda n: self.RANKS.get(n, 99))
        day = found[name]
        if self.RANKS.get(name, 99) <= 7:
            return name, day
        if push is None and stop is not None:
            day = max(day, stop)
        elif stop is None and push is not None:
            day = min(day, push)
        elif push is not None and push < day and stop != push:
            day = max(push, stop)
        elif push is not None and push > day and stop > day:
            day = stop
        return f"{name}:REFINED", day

    def records(self, i):
        category, end, _ = self.events[i]
        return sum(1 for _, d, _ in self.events.values() if 0 <= end - d < L.max_term[category])


def borrowed_prior(people, i):
    """Prior day that event number ``i`` borrows: from the person of that id, if it is their outcome."""
    lender = people.get(i)
    if lender is None or i not in lender.valid:
        return False
    return lender.prior(i)[0]
