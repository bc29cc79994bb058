"""Code lists and column-level classification rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category vocabulary.
OUTCOMES = ("LB", "SB", "DELIV", "TRO", "ECT", "AB", "SA")
TARGETS = ("LB", "SB", "ECT", "AB", "SA", "DELIV")  # order of acceptance
CARE = ("AGP", "PCONF")
ECTOPIC_MOVE = ("ECT_SURG1", "MTX")
ECTOPIC_PROOF = ("ECT_SURG1", "ECT_SURG2", "MTX")
LOSSES = ("SA", "AB")
DRUG_CATEGORIES = ("CONTRA", "MTX", "OVULDR")
DRUG_CLASSES = ("Branded Drug", "Branded Pack", "Clinical Drug", "Clinical Pack", "Ingredient")

# Categories that count as candidates beside the outcomes, by target.
EXTRA_CANDIDATES = {
    "LB": (),
    "SB": ("AGP", "PCONF"),
    "ECT": ("AGP", "PCONF", "ECT_SURG1", "ECT_SURG2", "MTX"),
    "AB": ("AGP", "PCONF"),
    "SA": ("AGP", "PCONF"),
    "DELIV": ("AGP", "PCONF"),
}

# Concept ids of the outcome column in the mother table.
OUTCOME_CONCEPTS = {
    "SA": 4067106,
    "DELIV": 4092289,
    "AB": 4081422,
    "ECT": 4081422,
    "LB": 4092289,
    "SB": 4067106,
}

FEMALE = 8532
MAX_GESTATION_DAYS = 301
EARLY_LOSS_DAYS = 140


def outcome_class(category: Column, length: Column) -> Column:
    """Reported outcome; a stillbirth below 20 weeks counts as a loss."""
    return (
        F.when(category.isin(*LOSSES), "SA/AB")
        .when(category.isin("DELIV", "LB"), "LB/DELIV")
        .when((category == "SB") & (length < EARLY_LOSS_DAYS), "SA/AB")
        .otherwise(category)
    )


def usable_event(category: Column, gest_days: Column) -> Column:
    """False for gestation records without a value or beyond 43 weeks; NULL for no category."""
    return ~((category == "GEST") & (gest_days.isNull() | (gest_days > MAX_GESTATION_DAYS)))


def matches_value(data_value: Column, value: Column) -> Column:
    """A code either takes any recorded value or one certain value."""
    return (data_value == "N/A") | (data_value == value)
