"""Named queries over the driver's tables, one per operator or rule."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.classify import DRUG_CATEGORIES, TARGETS
from natalis.functions.days import date_of, lookup
from natalis.operators import events as ev
from natalis.operators import outcomes as oc
from natalis.operators import starts as st
from natalis.operators import summaries as su
from natalis.operators.temporal import PERSON, latest_day
from natalis.options import Options
from natalis.plans.pipeline import EpisodePlan
from natalis.sources.cdm import Cdm
from natalis.sources.fixtures import code_set, fixture_cdm, split_cdm
from natalis.sources.store import read_events, write_events, write_records
from natalis.sources.tables import cut_lineage, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

AS_WRITTEN = Options()
FORWARD = Options(lb_gap="forward")


def plan_of(spark: SparkSession, sf_dir: str, options: Options = AS_WRITTEN) -> EpisodePlan:
    """The run over the tables in ``sf_dir``."""
    return EpisodePlan(fixture_cdm(spark, sf_dir), code_set(spark), options=options)


def code_map_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All coded records but drug exposures, from the four tables."""
    plan = plan_of(spark, sf_dir)
    records = Cdm.clinical_records(plan.cdm)
    return ev.map_codes(records, ev.code_map(plan.cdm, plan.codes)).select(
        "category",
        "gest_value",
        PERSON,
        "start_date",
        "type",
        "value_as_string",
        F.col("value_as_number").cast("double").alias("value_as_number"),
    )


def glucose_only_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons left out because glucose tests are all they have, with their records."""
    plan = plan_of(spark, sf_dir)
    counted = plan.by_person(plan.counted)
    flagged = counted.select("*", ev.glucose_only().alias("only"))
    return (
        flagged.filter(F.col("only") & ~F.col("for_drug"))
        .groupBy(PERSON)
        .agg(F.sum("n").alias("n_records"))
    )


def gestation_to_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events other than drugs with gestation in days, and the number of equal ones."""
    plan = plan_of(spark, sf_dir)
    cleaned = ev.clean_events(plan.by_person(plan.exact)).filter(~F.col("for_drug"))
    return cleaned.select(
        PERSON,
        "category",
        date_of("day").alias("event_date"),
        F.col("gest_value").cast("double").alias("gest_value"),
        "n",
    )


def drug_hierarchy_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drug concepts below the code sets, the ways to reach them and their exposures."""
    return _drug_ways(plan_of(spark, sf_dir))


def _drug_ways(plan: EpisodePlan) -> DataFrame:
    listed = ev.id_ranges(plan.codes.withColumn("for_drug", F.col("category").isin(*DRUG_CATEGORIES)).filter("for_drug"), "for_drug")
    expanded = ev.drug_codes(plan.cdm, plan.codes, listed.get(True, []))
    ways = expanded.groupBy("concept_id", "category").agg(F.count(F.lit(1)).alias("ways"))
    given = plan.cdm.drug_exposure.groupBy(F.col("drug_concept_id").alias("concept_id")).agg(
        F.count(F.lit(1)).alias("exposures")
    )
    return ways.join(given, "concept_id").select("concept_id", "category", "ways", "exposures")


def drug_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drug events of persons with other events, and the number of equal ones."""
    cleaned = plan_of(spark, sf_dir).cleaned.filter("for_drug")
    return cleaned.select(PERSON, "category", date_of("day").alias("event_date"), "n")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its number."""
    each = ev.numbered_events(plan_of(spark, sf_dir).events)
    return each.withColumn("gest_value", F.col("gest_value").cast("double"))


def candidate_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct events judged per target."""
    return oc.candidate_events(plan_of(spark, sf_dir).telling).select(
        "target",
        PERSON,
        "event_id",
        "category",
        date_of("day").alias("event_date"),
        F.col("gest_value").cast("double").alias("gest_value"),
    )


def first_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest candidate per person and target."""
    firsts = oc.first_candidates(oc.candidate_events(plan_of(spark, sf_dir).telling))
    return firsts.select("target", PERSON, "event_id", date_of("day").alias("event_date"))


def _revised(spark: SparkSession, sf_dir: str, *categories: str) -> DataFrame:
    revised = oc.revise_days(oc.split_candidates(plan_of(spark, sf_dir).telling))
    return revised.filter(F.col("candidate") & F.col("category").isin(*categories))


def _moves(spark: SparkSession, sf_dir: str, *categories: str) -> DataFrame:
    return _revised(spark, sf_dir, *categories).select(
        PERSON,
        "event_id",
        "category",
        date_of("day").alias("event_date"),
        date_of("end_day").alias("revised_date"),
    )


def revise_ectopic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ectopic pregnancies moved to the day of surgery or drug."""
    return _moves(spark, sf_dir, "ECT")


def revise_abortion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses moved to the last loss record in 14 days."""
    return _moves(spark, sf_dir, "AB", "SA")


def required_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ectopic pregnancies with surgery or drug in 14 days."""
    proven = _revised(spark, sf_dir, "ECT").filter("proven")
    return proven.select(PERSON, "event_id", date_of("day").alias("event_date"))


def _vetoed(spark: SparkSession, sf_dir: str, flag: str, *categories: str) -> DataFrame:
    plan = plan_of(spark, sf_dir)
    judged = oc.judged_candidates(plan.telling, plan.lookups)
    return judged.filter(F.col(flag) & F.col("category").isin(*categories)).select(
        PERSON, "event_id", "category", date_of("end_day").alias("event_date")
    )


def veto_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stillbirths with antenatal care in the 41 days before or on the day."""
    return _vetoed(spark, sf_dir, "cared_before", "SB")


def veto_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other outcomes with antenatal care in the 42 days after."""
    return _vetoed(spark, sf_dir, "cared_after", "ECT", "AB", "SA", "DELIV")


def spacing_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates too close to a live birth, with the live births on either side.

    The nearest live birth on a side has the smallest gap, so no pairs are made.
    """
    plan = plan_of(spark, sf_dir, FORWARD)
    births = oc.accept_outcomes(plan.telling, plan.lookups, plan.options, ("LB",), plan.parts).select(
        PERSON, "event_id", F.lit("LB").alias("category"), "end_day"
    )
    others = oc.judged_candidates(plan.telling, plan.lookups).filter("category <> 'LB'")
    line = births.unionByName(others.select(PERSON, "event_id", "category", "end_day")).repartition(plan.parts, PERSON)
    birth = F.col("category") == "LB"
    sided = line.withColumn("back_day", -F.col("end_day")).select(
        "*",
        latest_day(birth, "end_day").alias("before"),
        (-latest_day(birth, "back_day", -1)).alias("after"),
    )
    min_days = plan.lookups.min_days
    following = lookup("category", {c: min_days["LB", c] for c in TARGETS})
    leading = lookup("category", {c: min_days[c, "LB"] for c in TARGETS})
    clash = (oc.gap_days(F.col("before"), F.col("end_day")) < following) | (
        oc.gap_days(F.col("after"), F.col("end_day")) < leading
    )
    return sided.filter(~birth & clash).select(
        PERSON,
        "event_id",
        "category",
        date_of("end_day").alias("event_date"),
        date_of("before").alias("birth_before"),
        date_of("after").alias("birth_after"),
    )


def spacing_conflicts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates too close to any other accepted outcome, whatever its category."""
    plan = plan_of(spark, sf_dir, FORWARD)
    step = lookup("category", {target: i for i, target in enumerate(TARGETS, 1)})
    candidates = oc.judged_candidates(plan.telling, plan.lookups).withColumn("step", step)
    accepted = plan.outcomes.groupBy(PERSON).agg(
        F.collect_list(F.struct("event_id", "end_day", step.alias("step"))).alias("accepted")
    )
    close, own = oc.too_close(plan.lookups), F.struct("event_id", "end_day", "step")
    clash = F.exists("accepted", lambda other: (other["event_id"] != F.col("event_id")) & close(other, own))
    return candidates.join(accepted, PERSON).filter(clash).select(
        PERSON, "event_id", "category", date_of("end_day").alias("event_date")
    )


def _accepted(options: Options, *targets: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        plan = plan_of(spark, sf_dir, options)
        accepted = oc.accept_outcomes(plan.telling, plan.lookups, plan.options, targets, plan.parts)
        return accepted.select(PERSON, "event_id", "category", date_of("end_day").alias("event_date"))

    return query


def prior_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted outcomes with the one before."""
    return plan_of(spark, sf_dir).outcomes.select(
        PERSON,
        "event_id",
        "category",
        date_of("end_day").alias("event_date"),
        date_of("prior_day").alias("prior_outcome_date"),
        "prior_category",
    )


def _rule_start(rule: st.Rule, options: Options = AS_WRITTEN) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dated = plan_of(spark, sf_dir, options).dated_by((rule,))
        return dated.filter(F.col(rule.column).isNotNull()).select(
            PERSON,
            "event_id",
            date_of(rule.column).alias("episode_start_date"),
            F.lit(rule.name).alias("start_category"),
        )

    return query


def _ranked_rows(starts: DataFrame) -> DataFrame:
    return starts.select(
        PERSON,
        "event_id",
        date_of("start_day").alias("episode_start_date"),
        "start_category",
        "date_rank",
    )


def start_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start assumed from the usual length, for every outcome."""
    plan = plan_of(spark, sf_dir)
    label, day = st.default_start(plan.lookups)
    return plan.outcomes.select(
        PERSON,
        "event_id",
        date_of(day).alias("episode_start_date"),
        label.alias("start_category"),
    )


def all_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ranked start of every outcome."""
    dated = plan_of(spark, sf_dir).dated
    return _ranked_rows(dated.select(PERSON, "event_id", F.inline("starts")))


def best_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest-ranked start of every outcome."""
    return _ranked_rows(plan_of(spark, sf_dir).dated.select(PERSON, "event_id", "best.*"))


def refined_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak starts moved by first care and contraception."""
    dated = plan_of(spark, sf_dir).dated.filter("refined IS NOT NULL")
    return _ranked_rows(dated.select(PERSON, "event_id", "refined.*"))


def episode_all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every outcome with every start, refined ones included."""
    return plan_of(spark, sf_dir).every_start.select(
        PERSON,
        date_of("start_day").alias("episode_start_date"),
        date_of("end_day").alias("episode_end_date"),
        "start_category",
        F.col("category").alias("outcome_category"),
        "date_rank",
    )


def _episode_rows(episodes: DataFrame) -> DataFrame:
    return episodes.select(
        PERSON,
        date_of("start_day").alias("episode_start_date"),
        date_of("end_day").alias("episode_end_date"),
        "start_category",
        F.col("category").alias("outcome_category"),
        "episode",
    )


def episodes_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered episodes that pass enrolment, sex and age."""
    return _episode_rows(plan_of(spark, sf_dir).eligible)


def episodes_corroborated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible episodes with two records or more."""
    return _episode_rows(plan_of(spark, sf_dir).corroborated)


def episodes_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table."""
    return plan_of(spark, sf_dir).episodes


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored_cdm(spark: SparkSession, sf_dir: str) -> Cdm:
    """The clinical tables stored by concept and read back."""
    folder = _folder(spark, "records")
    write_records(split_cdm(spark, sf_dir), folder)
    return Cdm.from_parquet(spark, folder)


def episodes_final_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table, from stored clinical tables of which only ranges of listed concepts are read."""
    return EpisodePlan(stored_cdm(spark, sf_dir), code_set(spark)).episodes


def coded_records_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All coded records, drug exposures too, from stored tables read by ranges of listed concepts."""
    coded = ev.coded_records(stored_cdm(spark, sf_dir), code_set(spark))
    return coded.select(PERSON, "type", "concept_id", "category", "start_date")


def drug_hierarchy_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drug concepts below the code sets and their exposures, the hierarchy read from storage below listed ancestors only."""
    return _drug_ways(EpisodePlan(stored_cdm(spark, sf_dir), code_set(spark)))


def episodes_final_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table, with records of persons without an outcome dropped before the first shuffle."""
    return EpisodePlan(fixture_cdm(spark, sf_dir), code_set(spark), early_persons=True).episodes


def episodes_final_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table of a second run, which starts from counted events stored by person."""
    first = plan_of(spark, sf_dir)
    table = f"events_{uuid.uuid4().hex}"
    write_events(first.counted, table, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return EpisodePlan(first.cdm, first.codes, stored_events=read_events(spark, table)).episodes


def episodes_final_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table under the rules as intended."""
    return plan_of(spark, sf_dir, Options.intended()).episodes


def full_outer_prior_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and term lengths of the outcome before, unmatched rows of both kept.

    A full join would send every row of a category to one task. The matched side
    is a broadcast lookup; terms without a match are found from the distinct
    prior categories.
    """
    plan = plan_of(spark, sf_dir)
    terms = plan.lookups.tables(spark)["term_durations"].select(
        F.col("category").alias("term_category"), "max_term", "min_term", "retry"
    )
    columns = [PERSON, "event_id", "prior_category", "term_category", "max_term", "min_term", "retry"]
    outcomes = plan.outcomes.select(PERSON, "event_id", "prior_category")
    same = F.col("prior_category") == F.col("term_category")
    matched = outcomes.join(F.broadcast(terms), same, "left").select(*columns)
    seen = outcomes.select("prior_category").distinct()
    unused = terms.join(seen, same, "left_anti")
    return matched.unionByName(unused, allowMissingColumns=True)


def mother_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes in the shape of the mother table."""
    return su.mother_table(cut_lineage(plan_of(spark, sf_dir).episodes))


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Births per ten days of length."""
    return su.length_histogram(plan_of(spark, sf_dir).episodes)


def episodes_per_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons by number of episodes."""
    return su.episodes_per_person(plan_of(spark, sf_dir).episodes)


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes by recorded outcome."""
    return su.outcome_counts(plan_of(spark, sf_dir).episodes)


def outcome_concept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes by the outcome's concept id, as in the mother table."""
    return su.outcome_concept_counts(plan_of(spark, sf_dir).episodes)


RULES = {rule.name: rule for rule in st.RULES}

QUERIES: dict[str, Query] = {
    "code_map_union": code_map_union,
    "glucose_only_exclusion": glucose_only_exclusion,
    "gestation_to_days": gestation_to_days,
    "drug_hierarchy_expand": drug_hierarchy_expand,
    "drug_events": drug_events,
    "numbered_events": numbered_events,
    "candidate_dedupe": candidate_dedupe,
    "first_candidate": first_candidate,
    "revise_ectopic": revise_ectopic,
    "revise_abortion": revise_abortion,
    "required_evidence": required_evidence,
    "veto_lookback": veto_lookback,
    "veto_lookahead": veto_lookahead,
    "spacing_conflicts": spacing_conflicts,
    "spacing_conflicts_all": spacing_conflicts_all,
    "accept_lb_as_written": _accepted(AS_WRITTEN, "LB"),
    "accept_lb_forward": _accepted(FORWARD, "LB"),
    "accept_all_as_written": _accepted(AS_WRITTEN, *TARGETS),
    "accept_all_forward": _accepted(FORWARD, *TARGETS),
    "accept_all_veto_ahead": _accepted(Options(sb_veto="ahead"), *TARGETS),
    "accept_all_intended": _accepted(Options.intended(), *TARGETS),
    "prior_outcome": prior_outcome,
    "start_lmp": _rule_start(RULES["LMP"]),
    "start_gest": _rule_start(RULES["GEST"]),
    "start_ovul": _rule_start(RULES["OVUL"]),
    "start_ovul2": _rule_start(RULES["OVUL2"]),
    "start_ovul2_person": _rule_start(RULES["OVUL2"], Options(ovul2_join="person")),
    "start_nuchal": _rule_start(RULES["NULS"]),
    "start_afp": _rule_start(RULES["AFP"]),
    "start_amen": _rule_start(RULES["AMEN"]),
    "start_up": _rule_start(RULES["UP"]),
    "start_pushback": _rule_start(RULES["PUSHBACK"]),
    "start_contra": _rule_start(RULES["CONTRA"]),
    "start_default": start_default,
    "all_starts": all_starts,
    "best_start": best_start,
    "refined_start": refined_start,
    "episode_all_candidates": episode_all_candidates,
    "episodes_eligible": episodes_eligible,
    "episodes_corroborated": episodes_corroborated,
    "episodes_final": episodes_final,
    "episodes_final_split": episodes_final_split,
    "episodes_final_early": episodes_final_early,
    "episodes_final_events": episodes_final_events,
    "episodes_final_intended": episodes_final_intended,
    "coded_records_stored": coded_records_stored,
    "drug_hierarchy_stored": drug_hierarchy_stored,
    "full_outer_prior_terms": full_outer_prior_terms,
    "mother_table": mother_table,
    "length_histogram": length_histogram,
    "episodes_per_person": episodes_per_person,
    "outcome_counts": outcome_counts,
    "outcome_concept_counts": outcome_concept_counts,
}
