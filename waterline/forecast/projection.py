"""Projecting fitted series and presenting the result."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.forecast.features import calendar_columns
from waterline.forecast.fit import keys, predict, terms, whole
from waterline.forecast.models import Model
from waterline.functions.money import finite

DEFAULT_MONTHS = 12


def _linspace(last: Column, multiplier: Column, step: Column, months: int) -> Column:
    """From ``last`` in step 1 to ``last * multiplier`` in the final step."""
    if months == 1:
        return last
    grown = last + (last * multiplier - last) * (step - 1) / (months - 1)
    return F.when(multiplier == 1.0, last).otherwise(grown)


def scenario_table(scenarios: DataFrame, model: Model, known: Iterable[str] | None = None) -> DataFrame:
    """``(scenario, feature, end_multiplier)`` with a row for every feature of ``model``.

    A feature that a scenario does not name, or whose multiplier is null, has the model's own growth.
    Names are to be among ``known``, the model's features unless said otherwise; others are an error,
    and so is a feature named twice in one scenario.
    """
    allowed = sorted(set(model.features if known is None else known))
    named = F.when(F.col("feature").isin(allowed), F.col("feature")).otherwise(
        F.raise_error(F.concat(F.lit("not a feature: "), F.coalesce(F.col("feature"), F.lit("null")))).cast("string")
    )
    given = scenarios.groupBy("scenario").agg(
        F.map_from_entries(F.collect_list(F.struct(named, F.col("end_multiplier").cast("double")))).alias("given")
    )
    usual = F.create_map(*[F.lit(v) for f in model.features for v in (f, float(model.growth.get(f, 1.0)))])
    return given.select("scenario", "given", F.explode(usual).alias("feature", "usual")).select(
        "scenario", "feature", F.coalesce(F.col("given")[F.col("feature")], "usual").alias("end_multiplier")
    )


def future_frame(
    frame: DataFrame,
    model: Model,
    months: int = DEFAULT_MONTHS,
    scenario: Mapping[str, float] | DataFrame | None = None,
    known: Iterable[str] | None = None,
) -> DataFrame:
    """Features of the next ``months`` months of every series, plus its last actual value.

    Time moves on; everything else stays at its last value or grows evenly to the scenario's
    multiple of it. Projected months are dated at their end. ``scenario`` is one scenario as a
    mapping, or a table ``(scenario, feature, end_multiplier)`` of any number (``scenario_table``
    says how it is read): then every series has rows for each, told apart by ``scenario``.
    """
    kept = list(dict.fromkeys(["month_sequential", *model.features, model.target]))
    last = frame.groupBy("tier").agg(
        F.max_by(F.struct("month", *kept), "month").alias("last"),
        F.max("month_sequential").alias("last_seq"),
    )
    if isinstance(scenario, DataFrame):
        # a series' features as rows meet those of all scenarios by name, and become a map again
        values = F.map_from_arrays(
            F.array(*[F.lit(f) for f in model.features]), F.array(*[F.col(f"last.{f}").cast("double") for f in model.features])
        )
        met = last.select("*", F.explode(values).alias("feature", "value")).join(scenario_table(scenario, model, known), "feature")
        last = met.groupBy("tier", "scenario").agg(
            F.first("last").alias("last"),
            F.first("last_seq").alias("last_seq"),
            F.map_from_entries(F.collect_list(F.struct("feature", "end_multiplier"))).alias("growth"),
        )
    else:
        growth = {**model.growth, **(scenario or {})}
        unknown = set(growth) - set(model.features)
        if unknown:
            raise ValueError(f"not features of {model.name}: {', '.join(sorted(unknown))}")
        pairs = [F.lit(v) for f in model.features for v in (f, float(growth.get(f, 1.0)))]
        last = last.withColumn("growth", F.create_map(*pairs))
    steps = last.withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(months)))
    ).withColumn(
        "date",
        F.last_day(F.add_months(F.to_date(F.concat("last.month", F.lit("-01"))), F.col("step"))),
    )
    step = F.col("step")
    number = F.month("date")
    sequence = F.col("last_seq") + step
    moving = {
        "month_sequential": sequence,
        "month_sequential_squared": sequence * sequence,
        "month_number": number,
        **calendar_columns(number),
    }
    features = [
        finite(
            moving.get(f, _linspace(F.col(f"last.{f}"), F.col("growth")[f], step, months))
        ).alias(f)
        for f in model.features
    ]
    return steps.select(
        *keys(last),
        "date",
        F.date_format("date", "yyyy-MM").alias("month"),
        sequence.cast("bigint").alias("sequence"),
        F.col(f"last.{model.target}").alias("last_actual"),
        *features,
    )


def ahead(future: DataFrame, model: Model) -> DataFrame:
    """A future frame with the model's terms as one array, its floor and months to a year: alike for all models."""
    return future.select(
        *keys(future),
        "date",
        "month",
        "sequence",
        F.col("last_actual").cast("double").alias("last_actual"),
        terms(model).alias("terms"),
        F.lit(model.floor_share).cast("double").alias("floor_share"),
        F.lit(12 if model.annualise else None).cast("int").alias("annual"),
    )


def project(ahead: DataFrame, fits: DataFrame) -> DataFrame:
    """``(tier, date, month, month_sequential, last_actual, trend, projected_value, projected_arr)``.

    ``model`` and ``scenario`` follow ``tier`` where the frames have them; one fit serves all scenarios.
    """
    floor = F.col("last_actual") * F.col("floor_share")
    value = F.when(F.col("floor_share").isNull(), F.col("trend")).otherwise(F.greatest("trend", floor))
    return (
        ahead.join(whole(fits), keys(fits))
        .withColumn("trend", predict(F.col("terms")))
        .withColumn("projected_value", value)
        .select(
            *keys(ahead),
            "date",
            "month",
            F.col("sequence").alias("month_sequential"),
            "last_actual",
            "trend",
            "projected_value",
            (F.col("projected_value") * F.col("annual")).alias("projected_arr"),
        )
    )


def _month_start(month: Column) -> Column:
    return F.to_date(F.concat(month, F.lit("-01")))


def _same_series(history: DataFrame, projections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The past of a series belongs to no scenario: its ``scenario`` is null where projections have one."""
    if "scenario" in projections.columns:
        history = history.withColumn("scenario", F.lit(None).cast("string"))
    return history, projections


def trend_table(history: DataFrame, projections: DataFrame) -> DataFrame:
    """``(tier, month, historical_data, projected_data, model_trend_line)``, past then future."""
    none = F.lit(None).cast("double")
    history, projections = _same_series(history, projections)
    past = history.select(
        *keys(history),
        _month_start(F.col("month")).alias("month"),
        F.col("target").alias("historical_data"),
        none.alias("projected_data"),
        F.col("prediction").alias("model_trend_line"),
    )
    ahead = projections.select(
        *keys(projections),
        F.col("date").alias("month"),
        none.alias("historical_data"),
        F.col("projected_value").alias("projected_data"),
        F.col("trend").alias("model_trend_line"),
    )
    return past.unionByName(ahead)


def typed_history(history: DataFrame, projections: DataFrame) -> DataFrame:
    """``(tier, month, month_sequential, mrr, type)``."""
    history, projections = _same_series(history, projections)
    past = history.select(
        *keys(history),
        _month_start(F.col("month")).alias("month"),
        F.col("month_sequential").cast("bigint").alias("month_sequential"),
        F.col("target").alias("mrr"),
        F.lit("Historical").alias("type"),
    )
    ahead = projections.select(
        *keys(projections),
        F.col("date").alias("month"),
        "month_sequential",
        F.col("projected_value").alias("mrr"),
        F.lit("Projected").alias("type"),
    )
    return past.unionByName(ahead)


def growth_summary(projections: DataFrame) -> DataFrame:
    """Current and final value of every series with total (%) and monthly growth.

    Monthly growth is 0 without a positive current value and NULL where the final one is negative.
    """
    now, final = F.col("current_value"), F.col("projected_value")
    n = F.col("months")
    total = F.when(now == 0, 0.0).otherwise(F.try_divide(final - now, F.abs(now)) * 100)
    monthly = F.when(now <= 0, 0.0).when(
        final >= 0, F.pow(F.try_divide(final, now), F.try_divide(F.lit(1.0), n)) - 1
    )
    return (
        projections.groupBy(*keys(projections))
        .agg(
            F.count("*").alias("months"),
            F.max("last_actual").alias("current_value"),
            F.max_by("projected_value", "date").alias("projected_value"),
            F.max_by("projected_arr", "date").alias("projected_arr"),
        )
        .withColumns({"total_growth": total, "monthly_growth_rate": monthly})
    )
