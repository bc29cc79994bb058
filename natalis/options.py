"""Choices where the rules can be read as written or as intended."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """Rule variants and thresholds.

    lb_gap
        ``as_written``: the first live birth removes every later one.
        ``forward``: only those closer than the spacing limit.
    sb_veto
        ``back``: care in the 41 days before a stillbirth (or on its day) rejects it.
        ``ahead``: care in the 42 days after it does, as for the other outcomes.
    ovul2_join
        ``as_written``: the prior date is borrowed from a person whose id equals
        the outcome's event id. ``person``: it is the person's own.
    """

    lb_gap: str = "as_written"
    sb_veto: str = "back"
    ovul2_join: str = "as_written"
    min_records: int = 2
    min_age: int = 12
    max_age: int = 55

    def __post_init__(self) -> None:
        allowed = {
            "lb_gap": ("as_written", "forward"),
            "sb_veto": ("back", "ahead"),
            "ovul2_join": ("as_written", "person"),
        }
        for name, choices in allowed.items():
            if getattr(self, name) not in choices:
                raise ValueError(f"{name} must be one of {choices}")

    @classmethod
    def intended(cls) -> Options:
        return cls(lb_gap="forward", sb_veto="ahead", ovul2_join="person")
