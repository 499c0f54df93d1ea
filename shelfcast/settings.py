"""Lab rules and run parameters.

Rules are data: a small list of ``LabRule`` that operators turn into ``CASE`` expressions, so
looking a rule up by lab name costs no join whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.sources.feeds import FEEDS, Feed


@dataclass(frozen=True)
class LabRule:
    """How one lab name is judged.

    ``threshold`` is a constant, or a quantile of the day's own values when ``is_quantile``.
    ``count_side`` says which side of the threshold the daily feature counts; values equal to
    the threshold belong to ``'above'``. ``abnormal`` maps the value column to a boolean.
    """

    base_name: str
    is_quantile: bool
    threshold: float
    abnormal: Callable[[Column], Column]
    count_side: str = "below"

    def __post_init__(self) -> None:
        if self.count_side not in ("below", "above"):
            raise ValueError(f"count_side of {self.base_name} must be 'below' or 'above'")
        if self.is_quantile and not 0 <= self.threshold <= 1:
            raise ValueError(f"quantile of {self.base_name} must lie in [0, 1]")


def quantile_rule(name: str, p: float, abnormal, count_side: str = "below") -> LabRule:
    return LabRule(name, True, p, abnormal, count_side)


def constant_rule(name: str, limit: float, abnormal, count_side: str = "below") -> LabRule:
    return LabRule(name, False, limit, abnormal, count_side)


# Lab names, feature thresholds and abnormal limits.
DEFAULT_RULES = (
    quantile_rule("HGB", 0.25, lambda v: v < 9.0),
    quantile_rule("LYMAB", 0.25, lambda v: v < 0.69),
    quantile_rule("MCH", 0.25, lambda v: v < 29.0),
    constant_rule("MCHC", 32.0, lambda v: v < 32.0),
    quantile_rule("MCV", 0.25, lambda v: v < 87.0),
    constant_rule("PLT", 150.0, lambda v: v < 150.0),
    constant_rule("RBC", 4.4, lambda v: v < 4.4),
    constant_rule("RDW", 12.0, lambda v: v < 11.5),
    quantile_rule("WBC", 0.25, lambda v: v > 10.3, count_side="above"),
)
# Defined alongside the others, but left out of the default set.
HCT_RULE = constant_rule("HCT", 40.0, lambda v: v < 34.0)

# The wards that become columns of the training table.
DEFAULT_WARDS = (
    "B1", "B2", "B3", "C1", "C2", "C3", "CAPR XFER OVERFL", "CATH PACU", "CDU-CLIN DEC UNIT",
    "D1CC", "D1CS", "D2", "D3", "DGR", "E1", "E2-ICU", "E29-ICU", "E3", "EMERGENCY DEPARTMENT",
    "F3", "FGR", "G1", "G2P", "G2S", "H1", "H2",
)


@dataclass(frozen=True)
class Params:
    """Run parameters. The six model fields are the ones whose change forces a retrain."""

    c0: float = 15.0
    min_inventory: float = 30.0
    history_window: int = 200
    penalty_factor: float = 15.0
    start: int = 10
    model_update_frequency: int = 7
    initial_collection: tuple[float, float, float] = (60.0, 60.0, 60.0)
    initial_expiry: tuple[float, float] = (0.0, 0.0)
    smoothing: int = 7
    rules: Sequence[LabRule] = field(default=DEFAULT_RULES, repr=False)
    wards: Sequence[str] = field(default=DEFAULT_WARDS, repr=False)
    feeds: Sequence[Feed] = field(default=tuple(FEEDS.values()), repr=False)

    def __post_init__(self) -> None:
        if len(self.initial_collection) != 3 or min(self.initial_collection) < 0:
            raise ValueError("initial_collection needs three non-negative numbers")
        if len(self.initial_expiry) != 2 or min(self.initial_expiry) < 0:
            raise ValueError("initial_expiry needs two non-negative numbers")


MODEL_FIELDS = (
    "c0", "min_inventory", "history_window", "penalty_factor", "start", "model_update_frequency",
)


def rule_names(rules: Sequence[LabRule]) -> list[str]:
    return [r.base_name for r in rules]


def by_rule(name: Column, rules: Sequence[LabRule], pick: Callable[[LabRule], Column]) -> Column:
    """``CASE name WHEN rule.base_name THEN pick(rule) ... END``; NULL for a name without rule."""
    return reduce(
        lambda acc, r: acc.when(name == r.base_name, pick(r)),
        rules[1:],
        F.when(name == rules[0].base_name, pick(rules[0])),
    )
