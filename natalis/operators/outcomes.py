"""Which recorded outcomes are real: revised dates, evidence, vetoes, spacing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.classify import (
    CARE,
    ECTOPIC_MOVE,
    ECTOPIC_PROOF,
    EXTRA_CANDIDATES,
    LOSSES,
    OUTCOMES,
    TARGETS,
)
from natalis.functions.days import lookup
from natalis.lookups import Lookups
from natalis.operators.temporal import (
    PERSON,
    greedy_accept,
    latest_day,
    prior_of,
    total_within,
    whole_person,
    with_islands,
)
from natalis.options import Options

MOVED = ("ECT", "AB", "SA")
MOVE_DAYS = 14
CARE_DAYS = 42
AFTERCARE_DAYS = 30


def _is(*categories: str) -> Column:
    return F.col("category").isin(*categories)


def candidate_events(events: DataFrame, targets: Iterable[str] = TARGETS) -> DataFrame:
    """Per target, the distinct events that persons with that target are judged on."""

    def entry(target: str) -> Column:
        held = F.array_contains("_held", target)
        return F.when(held & _is(*OUTCOMES, *EXTRA_CANDIDATES[target]), F.lit(target))

    kinds = F.collect_set(F.when(_is(*TARGETS), F.col("category"))).over(whole_person())
    tagged = events.withColumn("_held", kinds).select(
        PERSON,
        "category",
        "day",
        "gest_value",
        "event_id",
        F.explode(F.array_compact(F.array(*(entry(t) for t in targets)))).alias("target"),
    )
    return tagged.groupBy("target", PERSON, "category", "day", "gest_value").agg(
        F.min("event_id").alias("event_id")
    )


def first_candidates(candidates: DataFrame) -> DataFrame:
    """Earliest event of the target category per target and person."""
    own = candidates.filter(F.col("category") == F.col("target"))
    first = F.min(F.struct("day", "event_id"))
    return own.groupBy("target", PERSON).agg(first.alias("first")).select("target", PERSON, "first.*")


def split_candidates(events: DataFrame) -> DataFrame:
    """Mark one record per outcome event as the candidate, apart from its equal copies.

    Only the candidate of an ectopic pregnancy or a loss can move to another day.
    """
    alone = F.array(_part(F.col("event_id"), F.col("n"), True))
    parted = F.array(
        _part(F.col("event_id"), F.lit(1), True),
        _part(F.col("event_id") + 1, F.col("n") - 1, False),
    )
    parts = F.when(_is(*MOVED) & (F.col("n") > 1), parted).otherwise(alone)
    return events.select(PERSON, "category", "day", F.inline(parts))


def _part(event_id: Column, n: Column, candidate: bool) -> Column:
    return F.struct(
        event_id.cast("long").alias("event_id"),
        n.cast("long").alias("n"),
        F.lit(candidate).alias("candidate"),
    )


def revise_days(split: DataFrame) -> DataFrame:
    """Move ectopic pregnancies and losses to the end of their treatment.

    Adds ``proven`` (ectopic pregnancy with surgery or drug in 14 days) and
    ``end_day``. Losses recorded as SA are moved after those recorded as AB and
    see their new days.
    """
    candidate = F.col("candidate")
    surgery = F.coalesce(latest_day(_is(*ECTOPIC_MOVE), "day", MOVE_DAYS) >= F.col("day"), F.lit(False))
    proof = F.coalesce(latest_day(_is(*ECTOPIC_PROOF), "day", MOVE_DAYS) >= F.col("day"), F.lit(False))
    ectopic_day = F.when(surgery, latest_day(_is(*ECTOPIC_MOVE), "day", MOVE_DAYS)).otherwise(F.col("day"))
    first = split.select(
        "*",
        proof.alias("proven"),
        F.when(_is("ECT") & candidate, ectopic_day)
        .when(_is("AB") & candidate, latest_day(_is(*LOSSES), "day", MOVE_DAYS))
        .otherwise(F.col("day"))
        .alias("_day"),
    )
    second = F.when(_is("SA") & candidate, latest_day(_is(*LOSSES), "_day", MOVE_DAYS)).otherwise(F.col("_day"))
    return first.select("*", second.alias("end_day")).drop("_day")


def care_before(day: str) -> Column:
    """Antenatal care on the day or in the 41 days before."""
    last = latest_day(_is(*CARE), day)
    return F.coalesce(last > F.col(day) - CARE_DAYS, F.lit(False))


def care_after(day: str) -> Column:
    """Antenatal care in the 42 days after the day."""
    last = latest_day(_is(*CARE), day, CARE_DAYS)
    return F.coalesce(last > F.col(day), F.lit(False))


def judged_candidates(events: DataFrame, lookups: Lookups) -> DataFrame:
    """Candidates of all targets with everything that does not depend on other outcomes.

    Besides flags, this counts the person's records over the outcome's longest
    term and finds the latest term remarks up to 30 days after it. All are read
    in one walk over the person's events by revised day.
    """
    spans = sorted(set(lookups.max_term[target] for target in TARGETS))
    records = F.coalesce(
        *(F.when(lookup("category", lookups.max_term) == s, total_within("n", "end_day", s)) for s in spans)
    )
    revised = revise_days(split_candidates(events))
    return revised.select(
        "*",
        care_before("end_day").alias("cared_before"),
        care_after("end_day").alias("cared_after"),
        records.alias("records"),
        latest_day(_is("PREM"), "end_day", AFTERCARE_DAYS).alias("prem_day"),
        latest_day(_is("FT"), "end_day", AFTERCARE_DAYS).alias("ft_day"),
    ).filter(F.col("candidate") & _is(*TARGETS))


def admissible(options: Options) -> Column:
    """Whether a candidate passes the rules on evidence and antenatal care."""
    care = F.col("cared_before") if options.sb_veto == "back" else F.col("cared_after")
    return (
        _is("LB")
        | (_is("SB") & ~care)
        | (_is("ECT") & F.col("proven") & ~F.col("cared_after"))
        | (_is("AB", "SA", "DELIV") & ~F.col("cared_after"))
    )


def gap_days(accepted_day: Column, candidate_day: Column) -> Column:
    """Days counted between an accepted outcome and a candidate, on either side."""
    return F.abs(candidate_day - accepted_day + 1)


def too_close(lookups: Lookups):
    """Conflict test of an accepted outcome and a candidate."""
    # A pair that the table lacks in either direction has no limit.
    known = lookups.min_days
    days = [str(known[a, b] if (a, b) in known and (b, a) in known else -1) for a in TARGETS for b in TARGETS]
    limits = F.expr(f"array({', '.join(days)})")
    width = len(TARGETS)

    def limit(first: Column, following: Column) -> Column:
        return F.get(limits, (first["step"] - 1) * width + following["step"] - 1)

    def test(accepted: Column, candidate: Column) -> Column:
        gap = gap_days(accepted["end_day"], candidate["end_day"])
        earlier = accepted["end_day"] <= candidate["end_day"]
        return gap < F.when(earlier, limit(accepted, candidate)).otherwise(limit(candidate, accepted))

    return test


OUTCOME_FIELDS = ("event_id", "category", "end_day", "records", "prem_day", "ft_day")


def accept_outcomes(
    events: DataFrame, lookups: Lookups, options: Options, targets: Iterable[str] = TARGETS, parts: int | None = None
) -> DataFrame:
    """Accepted outcomes with the outcome before: one row each.

    Targets are accepted in their fixed order, each candidate being checked
    against all outcomes accepted so far. As no limit reaches over a longer gap than the longest one, the candidates between two
    such gaps are an island that is walked by itself. As written, a person's first live birth is the only one, however
    far others are: it is found before the walk. Islands and outcomes are dealt to ``parts`` partitions, if they are given.
    """
    step = lookup("category", {target: i for i, target in enumerate(TARGETS, 1)})
    queue = (
        judged_candidates(events, lookups)
        .filter(admissible(options) & _is(*targets))
        .withColumn("step", step)
    )
    if options.lb_gap == "as_written":
        birth = F.struct("day", "event_id")
        first = F.min(F.when(_is("LB"), birth)).over(whole_person())
        queue = queue.withColumn("_first", first).filter(~_is("LB") | (birth == F.col("_first"))).drop("_first")
    islands = with_islands(queue, "end_day", max(lookups.min_days.values(), default=0))
    carried = [field for field in OUTCOME_FIELDS if field != "event_id"]
    accepted = greedy_accept(islands, ("step", "day", "event_id"), carried, too_close(lookups), ("island",), parts)
    if parts:
        accepted = accepted.repartition(parts, PERSON)
    # what is accepted stands as far apart as the limits ask for: a person's array is short
    outcomes = accepted.groupBy(PERSON).agg(F.flatten(F.collect_list("accepted")).alias("accepted"))
    by_day = F.sort_array(
        F.transform("accepted", lambda c: F.struct(c["end_day"].alias("end_day"), c.alias("outcome")))
    )
    rows = outcomes.select(PERSON, by_day.alias("_by_day"))
    prior = F.transform(
        "_by_day",
        lambda row, i: F.struct(
            *(row["outcome"][field].alias(field) for field in OUTCOME_FIELDS),
            prior_of(F.col("_by_day"), "outcome")(row, i)["end_day"].alias("prior_day"),
            prior_of(F.col("_by_day"), "outcome")(row, i)["category"].alias("prior_category"),
        ),
    )
    return rows.select(PERSON, F.inline(prior))
