"""Registered queries on monthly series derived from the driver's tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification.fixtures import CONFIG, sites
from verification.queries import staged
from waterline.config import FULL, SEGMENTS
from waterline.forecast import features, fit
from waterline.forecast.models import (
    ENDING_MRR,
    LARGE_SEGMENT,
    NET_NEW_MRR,
    OLS,
    TREND,
    Model,
)
from waterline.plans.forecasting import Forecast, auto_forecast, forecast, forecast_each
from waterline.plans.monthly import combined_metrics
from waterline.sources.monthly import complete_months
from waterline.sources.staging import materialise

# Whole-number columns, so that sums of products compare well across engines.
COUNTS = Model(
    name="counts",
    target="net_count",
    features=("month_sequential", "month_number", "new_count", "churn_count", "ending_count"),
    alpha=0.0,
)
TREND_LASSO = replace(TREND, name="trend_lasso", alpha=15.0)
# What a feature is multiplied by until the projection ends.
SCENARIO = {"arpu": 1.25, "churn": 0.8}
# Several, from one fit; what a scenario does not name grows as the model says.
SCENARIOS = {"steady": {"arpu": 1.0}, "growth": SCENARIO, "decline": {"ending_count": 0.7, "expansion": 0.5}}
# What ``Forecast.history`` has of the fits.
MODEL_COLUMNS = ("n_train", "intercept", "weights", "gap", "converged", "prediction")
# One series per segment instead of per tier.
SEGMENT_CONFIG = replace(CONFIG, tiers={f"segment_{s:02d}": (s,) for s in SEGMENTS})


def monthly_table(spark: SparkSession, sf: str, cfg=CONFIG) -> DataFrame:
    """The combined table, written once: a row per tier and month."""
    rows = staged(spark, sf, cfg)
    return materialise(combined_metrics(rows, sites(spark, sf), cfg), "combined")


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Floating-point sums differ in their last digits with the order of summation."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, special.get(c, digits)) for c in doubles})


def significant(df: DataFrame, count: int = 6) -> DataFrame:
    """The same for numbers of any size: so many significant digits."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    # adding zero makes a negative zero a plain one
    shown = {c: F.format_string(f"%.{count - 1}e", F.col(c) + 0.0) for c in doubles}
    return df.withColumns({c: F.when(F.col(c).isNotNull(), text).cast("double") for c, text in shown.items()})


def run(spark: SparkSession, sf: str, model: Model, months: int = 12) -> Forecast:
    return forecast(monthly_table(spark, sf), model, months)


def _calendar(spark, sf):
    months = complete_months(monthly_table(spark, sf))
    out = features.add_trend_features(features.add_calendar_features(months))
    return out.select(
        "tier", "month", "month_number", "quarter", "h2_indicator", "good_months", "bad_months",
        "month_sequential", "month_sequential_squared",
    )


def _with_tiers(spark, sf, column="net_new_mrr"):
    table = monthly_table(spark, sf)
    return features.add_tier_features(complete_months(table), table, column)


def _tier_features(spark, sf):
    out = _with_tiers(spark, sf, "new_mrr")
    return out.select("tier", "month", *[f"{t}_new_mrr" for t in features.PERFORMANCE_TIERS])


def _quality(spark, sf):
    out = features.add_quality_ratios(_with_tiers(spark, sf))
    return out.select(
        "tier", "month", "total_segment_mrr", "quality_ratio", "under_ratio", "quality_weighted"
    )


def _high_to_under(spark, sf):
    linear = features.add_high_to_under(_with_tiers(spark, sf)).withColumnRenamed(
        "high_to_under", "linear"
    )
    both = features.add_high_to_under(linear, log=True).withColumnRenamed("high_to_under", "log")
    return rounded(both.select("tier", "month", "linear", "log"), 9)


def _growth(spark, sf):
    out = features.add_growth_features(complete_months(monthly_table(spark, sf)))
    return out.select("tier", "month", *features.GROWTH_STEPS)


def _gram(spark, sf):
    frame = COUNTS.frame(monthly_table(spark, sf))
    return rounded(fit.moments(fit.design(frame, COUNTS)), 3)


def _line(model: Model):
    def query(spark, sf):
        out = fit.whole(run(spark, sf, model).fits)
        return rounded(
            out.select("tier", "n_train", "intercept", F.col("weights")[0].alias("slope"))
        )

    return query


def _trend_projection(spark, sf):
    out = run(spark, sf, TREND, 24).projections
    return rounded(out.drop("last_actual", "trend"))


def _fits(model: Model):
    def query(spark, sf):
        out = run(spark, sf, model).fits
        picked = out.select(
            "tier",
            "fold",
            "n_train",
            "intercept",
            F.posexplode("weights").alias("position", "weight"),
        )
        return significant(picked, 5)

    return query


def _dispatch(spark, sf):
    out = auto_forecast(monthly_table(spark, sf), choice=2).projections
    return significant(out.select("model", "tier", "month", "projected_value"))


def _scenarios(spark, sf):
    rows = [(name, *pair) for name, scenario in SCENARIOS.items() for pair in scenario.items()]
    table = spark.createDataFrame(rows, "scenario string, feature string, end_multiplier double")
    return significant(forecast(monthly_table(spark, sf), ENDING_MRR, 12, scenario=table).projections)


def _segments(spark, sf):
    table = monthly_table(spark, sf, SEGMENT_CONFIG).filter(F.col("tier") != FULL)
    return significant(forecast(table, ENDING_MRR, 12).growth)


def objective(rows: DataFrame, fits: DataFrame, *models: Model) -> DataFrame:
    """The penalised objective of every fit on its own training months, as a share of their target's variance."""
    series = fit.keys(fits)
    error = F.col("target") - fit.predict(F.col("terms"))
    size = F.aggregate("weights", F.lit(0.0), lambda total, w: total + F.abs(w))
    alpha = F.create_map(*[F.lit(v) for m in models for v in (m.name, float(m.alpha))])[F.col("model")]
    per_fit = rows.withColumnRenamed("fold", "own").join(fits, series).filter(F.col("own") != F.col("fold"))
    loss = per_fit.groupBy(*series, "fold").agg(
        (F.avg(error * error) / 2).alias("loss"), F.first(size).alias("size"), F.var_pop("target").alias("variance")
    )
    return loss.select(*series, "fold", ((F.col("loss") + alpha * F.col("size")) / F.col("variance")).alias("share"))


def _gaps(spark, sf):
    """The objective each penalised fit reached, of the models and of every fold; SQL has the lowest there is."""
    table = monthly_table(spark, sf)
    models = (ENDING_MRR, NET_NEW_MRR, LARGE_SEGMENT)
    names = F.explode(F.array(*[F.lit(m.name) for m in models])).alias("model")
    out = forecast_each(table, table.select("tier", names).distinct(), models)
    reached = objective(out.history.drop(*MODEL_COLUMNS), out.fits, *models)
    return rounded(reached.join(out.fits.select("tier", "model", "fold", "converged"), ["tier", "model", "fold"]), 7)


def _scenario(spark, sf):
    table = monthly_table(spark, sf)
    return significant(forecast(table, ENDING_MRR, 12, scenario=SCENARIO).projections)


QUERIES = {
    "fit_gaps": _gaps,
    "calendar_features": _calendar,
    "tier_features": _tier_features,
    "quality_ratios": _quality,
    "high_to_under": _high_to_under,
    "growth_rates": _growth,
    "gram_stats": _gram,
    "ols_trend": _line(TREND),
    "lasso_trend": _line(TREND_LASSO),
    "trend_quality": lambda s, d: rounded(run(s, d, TREND).performance, r2=8),
    "trend_projection": _trend_projection,
    "trend_table": lambda s, d: rounded(run(s, d, TREND).trend),
    "typed_history": lambda s, d: rounded(run(s, d, TREND).combined),
    "trend_growth_summary": lambda s, d: rounded(
        run(s, d, TREND).growth, monthly_growth_rate=9
    ),
    "lasso_ending": _fits(ENDING_MRR),
    "lasso_net_new": _fits(NET_NEW_MRR),
    "lasso_poly2": _fits(LARGE_SEGMENT),
    "ols_baseline": _fits(OLS),
    "fit_metrics": lambda s, d: significant(run(s, d, ENDING_MRR).performance),
    "coefficient_report": lambda s, d: significant(run(s, d, NET_NEW_MRR).coefficients, 5),
    "projection": lambda s, d: significant(run(s, d, ENDING_MRR).projections),
    "scenario_projection": _scenario,
    "scenario_table": _scenarios,
    "net_new_projection": lambda s, d: significant(run(s, d, NET_NEW_MRR).projections),
    "large_segment_projection": lambda s, d: run(s, d, LARGE_SEGMENT).projections,
    "ols_projection": lambda s, d: significant(run(s, d, OLS).projections),
    "growth_summary": lambda s, d: significant(run(s, d, ENDING_MRR).growth),
    "model_dispatch": _dispatch,
    "segment_forecast": _segments,
}
