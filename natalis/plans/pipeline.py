"""The whole run, from clinical tables to episodes, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.functions.classify import TARGETS
from natalis.lookups import Lookups
from natalis.operators import episodes as ep
from natalis.operators import events as ev
from natalis.operators import outcomes as oc
from natalis.operators import starts as st
from natalis.operators.prefilter import of_persons
from natalis.operators.temporal import PERSON, parts_for
from natalis.options import Options
from natalis.sources.cdm import Cdm
from natalis.sources.tables import cut_lineage


@dataclass(frozen=True)
class EpisodePlan:
    """Each stage of the run as a DataFrame.

    Building one stores and counts the code map (to choose how it is joined). Stages from ``dated`` on read
    two tables that building them stores in the checkpoint folder: ``kept``, the cleaned events of persons with
    an outcome, and ``valid_outcomes``. Records are scanned and outcomes accepted once, however many branches read them.

    ``store_events`` also writes the counted events there, which
    pays off when several earlier stages are computed from one plan. ``stored_events`` are counted events of an earlier
    run (``natalis.sources.store``), which are then used in place of the records.

    ``early_persons`` reads the records of outcomes first, which are few, and drops the records of all
    persons without one by a Bloom filter before anything is shuffled; the exact test stays. It pays off where
    most persons with a listed code have no outcome.
    """

    cdm: Cdm
    codes: DataFrame
    lookups: Lookups = field(default_factory=Lookups.fixed)
    options: Options = field(default_factory=Options)
    store_events: bool = False
    stored_events: DataFrame | None = None
    early_persons: bool = False

    @cached_property
    def _coded(self) -> DataFrame:
        return ev.coded_records(self.cdm, self.codes)

    @cached_property
    def parts(self) -> int:
        """Partitions by person. Adaptive execution would deal any input to as many as there are cores until they are large."""
        if self.stored_events is not None:
            rows = self.stored_events.count()
        else:
            rows = self.cdm.record_count(self._coded)
        return parts_for(self.codes.sparkSession, rows)

    def by_person(self, counted: DataFrame) -> DataFrame:
        """Counted events dealt by person; those of an earlier run are stored that way."""
        return counted if self.stored_events is not None else counted.repartition(self.parts, PERSON)

    def _stored(self, counted: DataFrame) -> DataFrame:
        return cut_lineage(counted) if self.store_events else counted

    @cached_property
    def exact(self) -> DataFrame:
        """Counted events with gestation as recorded."""
        return self._stored(ev.counted_events(self._coded))

    @cached_property
    def counted(self) -> DataFrame:
        """Counted events with gestation in whole and half days, which bounds a person's rows."""
        if self.stored_events is not None:
            return self.stored_events
        return self._stored(ev.counted_events(self._coded, exact=False))

    @cached_property
    def promising(self) -> DataFrame:
        """Counted events of at least the persons who have any outcome."""
        if not self.early_persons or self.stored_events is not None:
            return self.counted
        targets = ev.coded_records(self.cdm, self.codes.filter(F.col("category").isin(*TARGETS)))
        return self._stored(ev.counted_events(of_persons(self._coded, targets), exact=False))

    @cached_property
    def cleaned(self) -> DataFrame:
        return ev.clean_events(self.by_person(self.counted))

    @cached_property
    def events(self) -> DataFrame:
        """All events, gestation as recorded."""
        return ev.number_events(ev.clean_events(self.exact.repartition(self.parts, PERSON)))

    @cached_property
    def telling(self) -> DataFrame:
        """Events of the persons who have any outcome to be accepted."""
        return ev.number_events(self.cleaned.filter("has_target"))

    @cached_property
    def outcomes(self) -> DataFrame:
        return oc.accept_outcomes(self.telling, self.lookups, self.options, parts=self.parts)

    @cached_property
    def kept(self) -> DataFrame:
        """The cleaned events of the persons who have any outcome to be accepted, stored."""
        cleaned = ev.clean_events(self.by_person(self.promising))
        return cut_lineage(cleaned.filter("has_target").drop("has_target"))

    @cached_property
    def valid_outcomes(self) -> DataFrame:
        """The accepted outcomes, stored: all later branches read this table."""
        dealt = self.kept.repartition(self.parts, PERSON)  # a stored table doesn't tell how it was dealt
        return cut_lineage(oc.accept_outcomes(ev.number_events(dealt), self.lookups, self.options, parts=self.parts))

    def dated_by(self, rules: Sequence[st.Rule]) -> DataFrame:
        """Outcomes with the start day that each of ``rules`` finds; other rules cost nothing."""
        if any(rule.name == "OVUL2" for rule in rules):
            asked = st.ovul2_windows(self.valid_outcomes, self.lookups, self.options)
        else:
            asked = self.valid_outcomes.withColumn("ovul2_from", F.lit(None).cast("int"))
        return st.dated_outcomes(asked, self.kept, self.lookups, rules, self.parts)

    @cached_property
    def dated(self) -> DataFrame:
        return st.add_refined(st.add_starts(self.dated_by(st.RULES), self.lookups))

    @cached_property
    def every_start(self) -> DataFrame:
        return st.every_start(self.dated)

    @cached_property
    def eligible(self) -> DataFrame:
        chosen = st.chosen_start(self.dated)
        return ep.eligible_episodes(chosen, self.cdm.observation_period, self.cdm.person, self.options)

    @cached_property
    def corroborated(self) -> DataFrame:
        return ep.corroborated(self.eligible, self.options)

    @cached_property
    def episodes(self) -> DataFrame:
        return ep.final_episodes(self.corroborated)


def run(
    cdm: Cdm, codes: DataFrame, lookups: Lookups | None = None, options: Options | None = None
) -> DataFrame:
    """Episodes of all persons in ``cdm`` under the code set ``codes``."""
    return EpisodePlan(cdm, codes, lookups or Lookups.fixed(), options or Options()).episodes
