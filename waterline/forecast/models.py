"""The regression models and which series they apply to."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from waterline.config import FULL
from waterline.forecast.features import (
    add_calendar_features,
    add_growth_features,
    add_high_to_under,
    add_quality_ratios,
    add_tier_features,
    add_trend_features,
    clean,
    fill_median,
)
from waterline.sources.monthly import complete_months


@dataclass(frozen=True)
class Model:
    """A linear model of one target on monthly features.

    ``alpha`` is the weight of the L1 penalty next to half the mean squared error; 0 is ordinary
    least squares. ``growth`` multiplies a feature by the end of the projection; others stay flat.
    """

    name: str
    target: str
    features: tuple[str, ...]
    alpha: float
    degree: int = 1
    growth: Mapping[str, float] = field(default_factory=dict)
    floor_share: float | None = None
    annualise: bool = False
    prepare: Callable[[DataFrame, DataFrame], DataFrame] | None = None

    def frame(self, series: DataFrame, tiers: DataFrame | None = None) -> DataFrame:
        """Complete months with clean features. ``tiers``: where tier features come from."""
        months = complete_months(series)
        if self.prepare is not None:
            months = self.prepare(months, series if tiers is None else tiers)
        return clean(months, list(dict.fromkeys([*self.features, self.target])))


def _prepare_net_new(df: DataFrame, tiers: DataFrame) -> DataFrame:
    return (
        df.transform(add_calendar_features)
        .transform(add_trend_features)
        .transform(add_tier_features, tiers, "new_mrr")
        .transform(add_quality_ratios, "new_mrr")
        .transform(add_high_to_under, "new_mrr", True)
        .transform(fill_median, "new_count")
    )


def _prepare_ols(df: DataFrame, tiers: DataFrame) -> DataFrame:
    return add_growth_features(df)


# Targets, features in this order, penalties, growth and floor.
ENDING_MRR = Model(
    name="ending_mrr",
    target="ending_mrr",
    features=("month_sequential", "churn", "ending_count", "arpu", "month_number", "expansion"),
    alpha=15.0,
    growth={"arpu": 1.10},
    floor_share=0.5,
    annualise=True,
)
NET_NEW_MRR = Model(
    name="net_new_mrr",
    target="net_new_mrr",
    features=(
        "month_sequential",
        "month_sequential_squared",
        "month_number",
        "good_months",
        "bad_months",
        "h2_indicator",
        "quality_ratio",
        "quality_weighted",
        "under_ratio",
        "high_to_under",
        "new_count",
    ),
    alpha=1.0,
    prepare=_prepare_net_new,
)
LARGE_SEGMENT = Model(
    name="large_segment",
    target="ending_mrr",
    features=(
        "month_sequential",
        "month_number",
        "new_mrr",
        "churn",
        "ending_count",
        "ending_parpu",
        "starting_mrr",
    ),
    alpha=2.0,
    degree=2,
    floor_share=0.5,
    annualise=True,
)
OLS = Model(
    name="ols",
    target="ending_mrr",
    features=(
        "month_sequential",
        "month_number",
        "growth_1m",
        "growth_3m",
        "growth_6m",
        "churn",
    ),
    alpha=0.0,
    annualise=True,
    prepare=_prepare_ols,
)
TREND = Model(
    name="trend",
    target="ending_mrr",
    features=("month_sequential",),
    alpha=0.0,
    annualise=True,
)
MODELS = {m.name: m for m in (ENDING_MRR, NET_NEW_MRR, LARGE_SEGMENT, OLS, TREND)}

TARGET_CHOICES = {1: ENDING_MRR, 2: NET_NEW_MRR}


def model_for(tier: str, choice: int = 1) -> Model:
    """The full set takes the chosen target (1 Ending, 2 Net New), any other series Ending MRR."""
    if choice not in TARGET_CHOICES:
        raise ValueError(f"target choice: {choice!r}")
    return TARGET_CHOICES[choice] if tier == FULL else ENDING_MRR
