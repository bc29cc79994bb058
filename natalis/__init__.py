"""Obstetric episodes from coded clinical records, on Spark."""

from natalis.lookups import Lookups
from natalis.options import Options
from natalis.plans.pipeline import EpisodePlan, run
from natalis.sources.cdm import Cdm

__all__ = ["Cdm", "EpisodePlan", "Lookups", "Options", "run"]
