"""Fit and project many monthly series with one job per step, not one per series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.config import FULL
from waterline.forecast import fit as fitting
from waterline.forecast import projection
from waterline.forecast.models import ENDING_MRR, MODELS, Model, model_for
from waterline.sources.staging import materialise


@dataclass(frozen=True)
class Forecast:
    """All frames carry ``tier``, the series; with several models or scenarios also ``model`` or ``scenario``."""

    models: tuple[Model, ...]
    fits: DataFrame
    coefficients: DataFrame
    performance: DataFrame
    history: DataFrame
    projections: DataFrame

    @property
    def trend(self) -> DataFrame:
        return projection.trend_table(self.history, self.projections)

    @property
    def combined(self) -> DataFrame:
        return projection.typed_history(self.history, self.projections)

    @property
    def growth(self) -> DataFrame:
        return projection.growth_summary(self.projections)


def forecast(
    series: DataFrame,
    model: Model = ENDING_MRR,
    months: int = projection.DEFAULT_MONTHS,
    tiers: DataFrame | None = None,
    scenario: Mapping[str, float] | DataFrame | None = None,
) -> Forecast:
    """Fit ``model`` to every series of a monthly table and project it.

    ``tiers`` is the monthly table the tier features come from, if ``series`` lacks the tiers.
    ``scenario`` is what features are multiplied by until the end, as a mapping, or a table
    ``(scenario, feature, end_multiplier)`` whose scenarios are all projected from the one fit.
    Fits are written once: several results read them, and the solver should not run for each.
    """
    frame = model.frame(series, tiers)
    rows = fitting.design(frame, model)
    fits = materialise(fitting.fit(rows, model), "fits")
    future = projection.future_frame(frame, model, months, scenario)
    return Forecast(
        models=(model,),
        fits=fits,
        coefficients=fitting.coefficients(fits, model),
        performance=fitting.quality(rows, fits),
        history=fitting.fitted(rows, fits),
        projections=projection.project(projection.ahead(future, model), fits),
    )


def forecast_each(
    series: DataFrame,
    assigned: DataFrame,
    models: Iterable[Model] = tuple(MODELS.values()),
    months: int = projection.DEFAULT_MONTHS,
    tiers: DataFrame | None = None,
    scenarios: DataFrame | None = None,
) -> Forecast:
    """Every series with the models ``assigned`` to it: a table ``(tier, model)`` of names from ``models``.

    Each model makes terms of its own from the series assigned to it; from there on all series are one
    table, whose sums of products, fits and projections are one job each, whatever the number of models.
    All frames carry ``model`` beside ``tier``. A series may have several models; one without any is
    left out, a pair listed twice counts once, and a name that is not among ``models`` is an error.
    ``scenarios`` is as in ``forecast``, with features of any of the models.
    """
    models = tuple(models)
    known = sorted({f for m in models for f in m.features})
    unknown = F.raise_error(F.concat(F.lit("not a model: "), F.coalesce(F.col("model"), F.lit("null"))))
    name = F.when(F.col("model").isin([m.name for m in models]), F.col("model")).otherwise(unknown.cast("string"))
    assigned = materialise(assigned.select("tier", name.alias("model")).distinct(), "assigned")
    rows, ahead = [], []
    for model in models:
        own = assigned.filter(F.col("model") == model.name).select("tier")
        frame = model.frame(series.join(own, "tier", "left_semi"), series if tiers is None else tiers)
        label = F.lit(model.name)
        rows.append(fitting.design(frame, model).withColumn("model", label))
        future = projection.future_frame(frame, model, months, scenarios, known)
        ahead.append(projection.ahead(future, model).withColumn("model", label))
    rows, ahead = (reduce(DataFrame.unionByName, parts) for parts in (rows, ahead))
    rows = materialise(rows, "design")
    fits = materialise(fitting.fit(rows, *models), "fits")
    return Forecast(
        models=models,
        fits=fits,
        coefficients=fitting.coefficients(fits, *models),
        performance=fitting.quality(rows, fits),
        history=fitting.fitted(rows, fits),
        projections=projection.project(ahead, fits),
    )


def auto_forecast(
    series: DataFrame,
    choice: int = 1,
    months: int = projection.DEFAULT_MONTHS,
    tiers: DataFrame | None = None,
    scenarios: DataFrame | None = None,
) -> Forecast:
    """Every series with its own model, named in ``model``: ``Full`` by choice, all others Ending MRR."""
    full = model_for(FULL, choice)
    own = F.when(F.col("tier") == FULL, F.lit(full.name)).otherwise(F.lit(ENDING_MRR.name))
    assigned = series.select("tier", own.alias("model")).distinct()
    used = (ENDING_MRR,) if full is ENDING_MRR else (full, ENDING_MRR)
    return forecast_each(series, assigned, used, months, tiers, scenarios)
