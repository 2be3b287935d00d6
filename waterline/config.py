"""Run settings and the fixed business values the metrics depend on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. Results are only comparable when these are exactly as listed.
# ---------------------------------------------------------------------------
CORE_PACKAGES: tuple[str, ...] = (
    "Internet: 100 Mbps",
    "Internet: 120 Mbps",
    "Internet: 250 Mbps",
    "Internet: 350 Mbps",
    "Internet: 500 Mbps",
    "Internet: 1 Gbps",
    "Internet: 2 Gbps",
    "Internet: 3 Gbps",
    "Internet: 10 Gbps",
    "Internet: Equipment",
    "Internet: TiVo+",
    "TV: Additional Feature",
    "TV: Broadcast Fee",
    "TV: Equipment",
    "TV: Essentials",
    "TV: Favorites",
    "TV: Premier",
    "TV: Premium Content",
    "Voice: Additional Feature",
    "Voice: Local & Long Distance",
)

# Segments 24 and 27 belong to two tiers; 20 and 37 to none.
TIER_SEGMENTS: dict[str, tuple[int, ...]] = {
    "high_performers": (2, 3, 5, 11, 13, 14, 27, 42, 48),
    "moderate_performers": (
        1, 4, 6, 8, 10, 15, 16, 17, 18, 19, 21,
        22, 23, 24, 25, 29, 31, 35, 36, 41, 47, 50,
    ),
    "underperformers": (
        7, 9, 12, 24, 26, 27, 28, 30, 32, 33, 34,
        38, 39, 40, 43, 44, 45, 46, 49, 51, 52, 53,
    ),
}
FULL = "Full"
TIER_KEYS: dict[int, str] = {
    0: FULL,
    1: "high_performers",
    2: "moderate_performers",
    3: "underperformers",
}
SEGMENTS: tuple[int, ...] = tuple(range(1, 54))

UNUSED_COLUMNS: tuple[str, ...] = (
    "Account Name",
    "BH HP ID",
    "City",
    "Flag Code",
    "Flag Name",
    "Full Address",
    "GIS LOCID",
    "Period ARPU",
    "System Flag",
    "User",
    "User Name",
    "Week Number",
    "Week Number (concurrent from 2024)",
    "Zip",
)

ACTIVATE = "Activate"
CHANGE_OF_SERVICE = "Change of Service"
UPGRADE = "Upgrade"
DOWNGRADE = "Downgrade"

NEW, EXPANSION, CONTRACTION, CHURN, OTHER = (
    "New MRR",
    "Expansion",
    "Contraction",
    "Churn",
    "Other",
)
# Categories that are not listed rank after all listed ones.
CATEGORY_PRIORITY: dict[str, int] = {NEW: 1, EXPANSION: 2, CONTRACTION: 3, OTHER: 4}

UNKNOWN = "Unknown"
OPEN_YEAR = 2999
SPARSE_PERCENT = 50.0
CHURN_GRACE_DAYS = 30

GOOD_MONTHS: tuple[int, ...] = (3, 5, 6)
BAD_MONTHS: tuple[int, ...] = (7, 8, 10, 12)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """One run's analysis date and the choices the metrics leave open.

    ``as_of`` replaces the wall clock, so the same inputs always give the same output.
    """

    as_of: dt.date
    core_packages: Sequence[str] = CORE_PACKAGES
    tiers: Mapping[str, Sequence[int]] = field(default_factory=lambda: dict(TIER_SEGMENTS))
    # A contract that starts on the first counts in Starting and in New unless this is set.
    exclusive_start: bool = False
    # Of two contracts for the same package and start, prefer the open one over any dated one.
    open_wins: bool = False
    # Amount over a zero count: "inf" (signed), "null" or "zero".
    zero_denominator: str = "inf"
    # Mid-contract price changes on contracts without an end: "never" or "open".
    split_open: str = "never"
    # Follow price changes that apply to an already changed price inside one contract.
    chain_changes: bool = False
    # Recompute time keys of split rows instead of keeping those of the original contract.
    rekey_splits: bool = False

    def __post_init__(self) -> None:
        if self.zero_denominator not in ("inf", "null", "zero"):
            raise ValueError(f"zero_denominator: {self.zero_denominator!r}")
        if self.split_open not in ("never", "open"):
            raise ValueError(f"split_open: {self.split_open!r}")

    def tier_names(self) -> list[str]:
        return [FULL, *self.tiers]
