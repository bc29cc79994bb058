"""When each accepted outcome's pregnancy began: ranked evidence, then refinement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.functions.days import ceil_day, floor_day, gestation_start_micros, lookup
from natalis.lookups import Lookups
from natalis.operators.temporal import PERSON, broadcast_if_small
from natalis.options import Options

LATEST, EARLIEST, BY_EVIDENCE = "latest", "earliest", "by evidence"


@dataclass(frozen=True)
class Rule:
    """Evidence of ``categories`` dated ``offset`` days after the start it stands for."""

    name: str
    rank: int | None
    categories: tuple[str, ...]
    offset: int
    pick: str

    @property
    def column(self) -> str:
        return f"{self.name.lower()}_start"


# The start rules by rank; the last two only refine weak starts.
RULES = (
    Rule("LMP", 1, ("LMP",), 0, LATEST),
    Rule("GEST", 2, ("GEST",), 0, BY_EVIDENCE),
    Rule("OVUL", 3, ("OVUL",), 13, EARLIEST),
    Rule("OVUL2", 4, ("OVUL2",), 13, EARLIEST),
    Rule("NULS", 6, ("NULS",), 89, EARLIEST),
    Rule("AFP", 7, ("AFP",), 123, EARLIEST),
    Rule("AMEN", 80, ("AMEN",), 55, EARLIEST),
    Rule("UP", 90, ("UP",), 55, EARLIEST),
    Rule("PUSHBACK", None, ("PCONF", "AGP", "PCOMP", "TA"), 55, EARLIEST),
    Rule("CONTRA", None, ("CONTRA",), 0, LATEST),
)
DEFAULT_RANK = 99
STRONGEST_REFINED_RANK = 7

PACK = 1 << 32

OUTCOME, EVIDENCE, QUERY = 1, 0, 2  # on one day, evidence is read first

CARRIED = ("event_id", "category", "end_day", "records", "prem_day", "ft_day", "prior_day", "prior_category")


def window_of(lookups: Lookups, prior_day: Column) -> tuple[Column, Column]:
    """First and last day a pregnancy may start, given its outcome and the one before."""
    end = F.col("end_day")
    first = F.greatest(
        prior_day + lookup("category", lookups.retry), end - lookup("category", lookups.max_term)
    )
    return first, end - lookup("category", lookups.min_term)


def evidence(events: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Events that date a start by ``rules``: person, rule and the start as a (possibly split) day."""
    category = F.col("category")
    rule, offset = F.lit(None).cast("string"), F.lit(None).cast("int")
    for r in rules:
        rule = F.when(category.isin(*r.categories), r.name).otherwise(rule)
        offset = F.when(category.isin(*r.categories), r.offset).otherwise(offset)
    start = F.col("day") - offset
    micros = gestation_start_micros(F.col("day"), F.col("gest_value"))
    by_gestation = category == "GEST"
    return events.filter(category.isin(*(c for r in rules for c in r.categories))).select(
        PERSON,
        rule.alias("rule"),
        "day",
        F.when(by_gestation, floor_day(micros)).otherwise(start).alias("start_floor"),
        F.when(by_gestation, ceil_day(micros)).otherwise(start).alias("start_ceil"),
    )


def ovul2_windows(outcomes: DataFrame, lookups: Lookups, options: Options) -> DataFrame:
    """Add ``ovul2_from``, the first start day the second ovulation rule allows; ``outcomes`` is a stored table.

    As written, the rule takes the prior date of the outcome whose person id
    equals its event id. Person v is among those only with v events or more, so N events give at most
    sqrt(2N) such rows; they are counted before they are broadcast.
    """
    if options.ovul2_join == "person":
        return outcomes.withColumn("ovul2_from", window_of(lookups, F.col("prior_day"))[0])
    numbered = self_numbered(outcomes).select("event_id", F.col("prior_day").alias("_prior"), F.lit(True).alias("_hit"))
    lent = outcomes.join(broadcast_if_small(numbered, stored=True), "event_id", "left")
    first = window_of(lookups, F.col("_prior"))[0]
    return lent.withColumn("ovul2_from", F.when(F.col("_hit"), first)).drop("_prior", "_hit")


def self_numbered(outcomes: DataFrame) -> DataFrame:
    """Outcomes whose event id equals their person id."""
    return outcomes.filter(F.col(PERSON) == F.col("event_id"))


def dated_outcomes(
    outcomes: DataFrame, events: DataFrame, lookups: Lookups, rules: Sequence[Rule] = RULES, parts: int | None = None
) -> DataFrame:
    """Outcomes with one start day for each of ``rules``, NULL where nothing fits.

    A start window lies wholly after the prior outcome, so a piece of evidence
    can only belong to the next outcome after the start it stands for. Outcomes
    and evidence are laid on one time line per person and read backwards once.
    The second ovulation rule may look past the prior outcome; it is asked at
    the first day of its own window instead. The line is dealt to ``parts`` partitions, if they are given.
    """
    fields = F.struct(*CARRIED, "ovul2_from")
    ends = F.struct(F.lit(OUTCOME).alias("kind"), F.col("end_day").alias("at"))
    asks = F.struct(F.lit(QUERY).alias("kind"), F.col("ovul2_from").alias("at"))
    points = outcomes.select(PERSON, fields.alias("own"), F.inline(F.array(ends, asks))).filter("at IS NOT NULL")
    found = evidence(events, rules).select(
        "*", F.lit(EVIDENCE).alias("kind"), F.col("start_floor").alias("at")
    )
    line = found.unionByName(points, allowMissingColumns=True)
    if parts:
        line = line.repartition(parts, PERSON)
    backwards = (
        Window.partitionBy(PERSON)
        .orderBy(F.col("at").desc(), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upcoming = F.last(F.when(F.col("kind") == OUTCOME, F.col("own")), ignorenulls=True).over(backwards)
    ovul2 = F.when(F.col("rule") == "OVUL2", F.col("start_floor"))
    next_ovul2 = F.last(ovul2, ignorenulls=True).over(backwards)
    placed = line.select(
        PERSON,
        "kind",
        "rule",
        "day",
        "start_floor",
        "start_ceil",
        F.when(F.col("kind") == QUERY, F.col("own")).otherwise(upcoming).alias("of"),
        F.when(F.col("kind") == QUERY, next_ovul2).alias("next_ovul2"),
    )
    flat = placed.filter("of IS NOT NULL").select(
        PERSON, "of.*", "kind", "rule", "day", "start_floor", "start_ceil", "next_ovul2"
    )
    first, last = window_of(lookups, F.col("prior_day"))
    inside = (F.col("start_floor") >= first) & (F.col("start_ceil") <= last)
    kept = flat.filter((F.col("kind") != EVIDENCE) | inside)
    asked = F.max(F.when(F.col("next_ovul2") <= last, F.col("next_ovul2")))
    picks = [(asked if rule.name == "OVUL2" else _pick(rule)).alias(rule.column) for rule in rules]
    return kept.groupBy(PERSON, *CARRIED).agg(*picks)


def _pick(rule: Rule) -> Column:
    start = F.when(F.col("rule") == rule.name, F.col("start_floor"))
    if rule.pick == LATEST:
        return F.max(start)
    if rule.pick == EARLIEST:
        return F.min(start)
    # Latest evidence, then latest start, as one number: the aggregate stays in a hash table.
    newest = F.when(F.col("rule") == rule.name, F.col("day") * PACK + F.col("start_floor") + PACK // 2)
    return (F.pmod(F.max(newest), F.lit(PACK)) - PACK // 2).cast("int")


def default_start(lookups: Lookups) -> tuple[Column, Column]:
    """Label and day of the start assumed from the usual length of the outcome."""
    end, prior = F.col("end_day"), F.col("prior_day")
    since = F.greatest(prior, end - lookup("category", lookups.max_term))
    premature = F.coalesce(F.col("prem_day") >= since, F.lit(False))
    fullterm = F.coalesce(F.col("ft_day") >= since, F.lit(False))
    days = (
        F.when(premature, lookup("category", lookups.preterm))
        .when(fullterm, lookup("category", lookups.fullterm))
        .otherwise(lookup("category", lookups.nodata))
    )
    start = F.greatest(prior + lookup("prior_category", lookups.retry), end - days)
    return F.when(premature, "PREM").otherwise("DEFAULT"), start


def _start(rank: int, label: Column, day: Column) -> Column:
    return F.struct(F.lit(rank).alias("date_rank"), label.alias("start_category"), day.alias("start_day"))


def add_starts(dated: DataFrame, lookups: Lookups) -> DataFrame:
    """Add ``starts``, the ranked starts of each outcome, and ``best``, the first of them."""
    ranked = [
        F.when(F.col(r.column).isNotNull(), _start(r.rank, F.lit(r.name), F.col(r.column)))
        for r in RULES
        if r.rank is not None
    ]
    starts = F.array_compact(F.array(*ranked, _start(DEFAULT_RANK, *default_start(lookups))))
    return dated.withColumn("starts", starts).withColumn("best", F.array_min("starts"))


def refined_day() -> Column:
    """Best start, moved back to first care and on to the end of contraception.

    With both known, contraception counts unless care points to the best day
    itself; when both point to the same earlier day the best start stays.
    """
    best, push, stop = F.col("best.start_day"), F.col("pushback_start"), F.col("contra_start")
    return (
        F.when(push.isNull(), F.greatest(best, stop))
        .when(stop.isNull(), F.least(best, push))
        .when((push < best) & (push != stop), F.greatest(push, stop))
        .when(push > best, F.greatest(best, stop))
        .otherwise(best)
    )


def add_refined(started: DataFrame) -> DataFrame:
    """Add ``refined``, one rank above the best start where that start is weak."""
    best = F.col("best")
    weak = best["date_rank"] > STRONGEST_REFINED_RANK
    refined = F.struct(
        (best["date_rank"] - 1).alias("date_rank"),
        F.concat(best["start_category"], F.lit(":REFINED")).alias("start_category"),
        refined_day().alias("start_day"),
    )
    return started.withColumn("refined", F.when(weak, refined))


def every_start(refined: DataFrame) -> DataFrame:
    """A row per outcome and start, ranked and refined alike."""
    both = F.array_compact(F.concat(F.col("starts"), F.array("refined")))
    return refined.select(PERSON, "event_id", "category", "end_day", F.inline(both))


def chosen_start(refined: DataFrame) -> DataFrame:
    """The strongest start of each outcome."""
    chosen = F.coalesce(F.col("refined"), F.col("best"))
    return refined.withColumn("_chosen", chosen).select(
        PERSON, "category", "end_day", "records", "_chosen.start_category", "_chosen.start_day"
    )
