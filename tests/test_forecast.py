import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from waterline.forecast import features, fit, projection
from waterline.forecast.models import ENDING_MRR, LARGE_SEGMENT, NET_NEW_MRR, OLS, TREND, model_for
from waterline.forecast.solver import minimise
from waterline.plans.forecasting import auto_forecast, forecast, forecast_each
from waterline.schema import MONTHLY_SCHEMA
from waterline.sources import sinks
from waterline.sources.layout import Layout
from waterline.sources.runs import read_current

N = 41
TIERS = ["Full", "high_performers", "moderate_performers", "underperformers"]


def month(i):
    return f"{2020 + i // 12}-{i % 12 + 1:02d}"


@pytest.fixture(scope="module")
def monthly(spark):
    rng = np.random.default_rng(3)
    rows = []
    for t, tier in enumerate(TIERS):
        for i in range(N):
            row = dict.fromkeys(MONTHLY_SCHEMA.names, 0.0)
            row |= {
                "tier": tier,
                "month": month(i),
                "month_sequential": i + 1,
                "month_number": i % 12 + 1,
                "churn": float(rng.uniform(0, 300)),
                "ending_count": int(1000 + 9 * i + rng.integers(0, 40)),
                "arpu": float(50 + rng.normal()),
                "expansion": float(rng.uniform(0, 90)),
                "new_mrr": float(rng.uniform(100, 900)),
                "new_count": int(rng.integers(5, 50)),
                "net_new_mrr": float(rng.normal(50, 400)),
                "ending_parpu": float(40 + rng.normal()),
                "starting_mrr": float(9000 + 100 * i + rng.normal(0, 90)),
                "ending_mrr": float((t + 1) * (10_000 + 120 * i) + rng.normal(0, 300)),
            }
            rows.append(tuple(
                int(row[f.name]) if f.dataType.simpleString() == "bigint" else row[f.name]
                for f in MONTHLY_SCHEMA
            ))
    return spark.createDataFrame(rows, MONTHLY_SCHEMA).repartition(3).cache()


def matrices(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: r.month):
        x, y, f = out.setdefault(r.tier, ([], [], []))
        x.append(r.terms), y.append(r.target), f.append(r.fold)
    return {t: tuple(map(np.asarray, v)) for t, v in out.items()}


def violation(x, y, intercept, weights, alpha):
    """How far the optimality conditions of the penalised objective are from holding."""
    residual = y - intercept - x @ weights
    scale = np.abs((x - x.mean(0)).T @ (y - y.mean()) / len(y)).max()
    slope = (x - x.mean(0)).T @ residual / len(y)
    active = weights != 0
    off = np.abs(slope[active] - alpha * np.sign(weights[active])).max(initial=0)
    beyond = (np.abs(slope[~active]) - alpha).max(initial=0)
    return max(off, beyond, abs(residual.mean())) / max(scale, 1)


@pytest.mark.parametrize("model", [ENDING_MRR, NET_NEW_MRR, LARGE_SEGMENT, replace(ENDING_MRR, alpha=1e9)])
def test_optimality(monthly, model):
    rows = fit.design(model.frame(monthly), model)
    fits = fit.fit(rows, model).collect()
    data = matrices(rows)
    assert len(fits) == len(TIERS) * 6
    for r in fits:
        x, y, folds = data[r.tier]
        train = folds != r.fold
        assert r.n_train == train.sum()
        limit = 1e-5 if model.degree == 2 else 1e-7
        assert violation(x[train], y[train], r.intercept, np.array(r.weights), model.alpha) < limit
        if model.alpha == 1e9:
            assert not any(r.weights) and r.intercept == pytest.approx(y[train].mean())


def test_folds_are_contiguous(monthly):
    rows = fit.design(TREND.frame(monthly), TREND)
    _, _, folds = matrices(rows)["Full"]
    n = N - 1
    expected = [k for k in range(5) for _ in range(n // 5 + (k < n % 5))]
    assert folds.tolist() == expected
    short = fit.design(TREND.frame(monthly.filter("month_sequential <= 4")), TREND)
    assert fit.quality(short, fit.fit(short, TREND)).first().cv_mae is None
    uneven = fit.design(TREND.frame(monthly.filter("month_sequential <= 14")), TREND)
    assert matrices(uneven)["Full"][2].tolist() == [0] * 3 + [1] * 3 + [2] * 3 + [3] * 2 + [4] * 2


def test_ols_and_quality(monthly):
    rows = fit.design(OLS.frame(monthly), OLS)
    fits = fit.fit(rows, OLS)
    data = matrices(rows)
    quality = {r.tier: r for r in fit.quality(rows, fits).collect()}

    def solve(x, y):
        return np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]

    for r in fit.whole(fits).collect():
        x, y, folds = data[r.tier]
        expected = solve(x, y)
        assert np.allclose([r.intercept, *r.weights], expected, rtol=1e-6)
        error = y - np.column_stack([np.ones(len(y)), x]) @ expected
        held_out = []
        for k in range(5):
            w = solve(x[folds != k], y[folds != k])
            held_out.append(np.abs(y[folds == k] - w[0] - x[folds == k] @ w[1:]).mean())
        q = quality[r.tier]
        assert q.r2 == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum())
        assert q.mae == pytest.approx(np.abs(error).mean())
        assert q.rmse == pytest.approx(np.sqrt((error**2).mean()))
        assert q.cv_mae == pytest.approx(np.mean(held_out), rel=1e-6)


def test_minimiser_edge_cases():
    assert minimise(np.zeros((2, 2)), np.zeros(2), 1.0).tolist() == [0, 0]
    twin = np.array([[1.0, 1.0], [1.0, 1.0]])
    assert minimise(twin, np.array([3.0, 3.0]), 1.0).sum() == pytest.approx(2.0)
    assert minimise(np.array([[2.0]]), np.array([-3.0]), 1.0).tolist() == [-1.0]


def test_features(spark, monthly):
    months = NET_NEW_MRR.frame(monthly)
    rows = {r.month: r for r in months.filter("tier = 'high_performers'").collect()}
    assert len(rows) == N - 1 and month(N - 1) not in rows
    r = rows["2020-08"]
    assert (r.month_number, r.quarter, r.h2_indicator, r.good_months, r.bad_months) == (8, 3, 1, 0, 1)
    high, moderate, under = (r[f"{t}_new_mrr"] for t in TIERS[1:])
    assert high == r.new_mrr
    total = high + moderate + under
    assert r.quality_ratio == pytest.approx((high + moderate) / total)
    assert r.under_ratio == pytest.approx(under / total)
    assert r.high_to_under == pytest.approx(np.log1p(high) / np.log1p(under + 100))
    assert r.month_sequential_squared == r.month_sequential**2

    lonely = NET_NEW_MRR.frame(monthly.filter("tier = 'Full'")).first()
    assert (lonely.total_segment_mrr, lonely.quality_ratio, lonely.high_to_under) == (1.0, 0.0, 0.0)
    odd = spark.createDataFrame([(-1.0, 5.0), (-3.0, 5.0), (200.0, -100.0)], "h double, u double").select(
        F.col("h").alias("high_performers_x"), F.col("u").alias("underperformers_x")
    )
    assert [r.high_to_under for r in features.add_high_to_under(odd, "x", log=True).collect()][:2] == [0, 0]
    assert [r.high_to_under for r in features.add_high_to_under(odd, "x").collect()] == [
        pytest.approx(v) for v in (-1 / 105, -3 / 105, 1.0)
    ]


def test_growth_features(spark):
    df = spark.createDataFrame(
        [("t", month(i), v) for i, v in enumerate([0.0, 5.0, 10.0, 20.0, 10.0])],
        "tier string, month string, ending_mrr double",
    )
    rows = features.add_growth_features(df).orderBy("month").collect()
    assert [r.growth_1m for r in rows] == [0.0, 0.0, 1.0, 1.0, -0.5]
    assert [r.growth_3m for r in rows] == [0.0, 0.0, 0.0, 0.0, 1.0]


def test_projection(monthly):
    out = forecast(monthly, ENDING_MRR, 12)
    last = monthly.filter(f"tier = 'Full' AND month = '{month(N - 2)}'").first()
    rows = out.projections.filter("tier = 'Full'").orderBy("date").collect()
    assert [r.month for r in rows] == [month(N - 1 + i) for i in range(12)]
    assert rows[0].date == dt.date(2023, 5, 31) and rows[9].date == dt.date(2024, 2, 29)
    own = fit.whole(out.fits).filter("tier = 'Full'").first()
    for i, r in enumerate(rows):
        x = [N + i, last.churn, last.ending_count, last.arpu * (1 + 0.1 * i / 11), r.date.month, last.expansion]
        expected = own.intercept + np.dot(own.weights, x)
        assert r.trend == pytest.approx(expected)
        assert r.projected_value == pytest.approx(max(expected, last.ending_mrr / 2))
        assert r.projected_arr == pytest.approx(r.projected_value * 12)
        assert r.month_sequential == N + i
    trend = out.trend.filter("tier = 'Full'").collect()
    assert len(trend) == N - 1 + 12
    assert sum(r.historical_data is None for r in trend) == 12
    assert out.combined.filter("type = 'Historical'").count() == (N - 1) * 4
    growth = out.growth.filter("tier = 'Full'").first()
    now, final = last.ending_mrr, rows[-1].projected_value
    assert growth.total_growth == pytest.approx((final - now) / now * 100)
    assert growth.monthly_growth_rate == pytest.approx((final / now) ** (1 / 12) - 1)


def test_floor_and_scenario(monthly):
    falling = monthly.withColumn("ending_mrr", F.lit(5000.0) - 100 * F.col("month_sequential"))
    floored = replace(TREND, floor_share=0.5)
    rows = forecast(falling, floored, 24).projections.filter("tier = 'Full'").orderBy("date").collect()
    assert rows[-1].projected_value == pytest.approx(500.0) and rows[-1].trend < 0
    plain = forecast(falling, TREND, 24).growth.first()
    assert plain.monthly_growth_rate is None and plain.total_growth < -100
    frame = ENDING_MRR.frame(monthly)
    future = projection.future_frame(frame, ENDING_MRR, 3, {"churn": 0.5, "arpu": 1.0})
    rows = future.filter("tier = 'Full'").orderBy("date").collect()
    assert [r.churn / rows[0].churn for r in rows] == pytest.approx([1, 0.75, 0.5])
    assert len({r.arpu for r in rows}) == 1
    single = projection.future_frame(frame, ENDING_MRR, 1).collect()
    assert len(single) == 4
    with pytest.raises(ValueError):
        projection.future_frame(frame, ENDING_MRR, 3, {"typo": 2.0})


def test_growth_guards(spark):
    rows = [(t, dt.date(2024, 1, 31), now, final) for t, now, final in [("zero", 0.0, 5.0), ("neg", -10.0, 5.0)]]
    df = spark.createDataFrame(rows, "tier string, date date, last_actual double, projected_value double")
    got = {r.tier: r for r in projection.growth_summary(df.withColumn("projected_arr", F.lit(None).cast("double"))).collect()}
    assert (got["zero"].total_growth, got["zero"].monthly_growth_rate) == (0.0, 0.0)
    assert (got["neg"].total_growth, got["neg"].monthly_growth_rate) == (150.0, 0.0)


def test_dispatch(monthly):
    assert model_for("Full", 2) is NET_NEW_MRR and model_for("Full") is ENDING_MRR
    assert model_for("high_performers", 2) is ENDING_MRR
    with pytest.raises(ValueError):
        model_for("Full", 3)
    both = auto_forecast(monthly, choice=2)
    rows = both.projections.collect()
    assert {(r.tier, r.model) for r in rows} == {("Full", "net_new_mrr")} | {(t, "ending_mrr") for t in TIERS[1:]}
    assert all((r.projected_arr is None) == (r.model == "net_new_mrr") for r in rows)
    assert {r.model for r in auto_forecast(monthly).projections.collect()} == {"ending_mrr"}


def test_models_as_a_table(spark, monthly):
    pairs = [("Full", "net_new_mrr"), ("Full", "large_segment"), ("high_performers", "ending_mrr"), ("high_performers", "ending_mrr")]
    out = forecast_each(monthly, spark.createDataFrame(pairs, "tier string, model string"), months=3)
    fits = {(r.tier, r.model, r.fold): r for r in out.fits.collect()}
    assert len(fits) == 3 * 6
    for tier, model in dict.fromkeys(pairs):
        # the same numbers as from a job for this model alone
        alone = forecast(monthly, next(m for m in (NET_NEW_MRR, LARGE_SEGMENT, ENDING_MRR) if m.name == model), 3)
        for r in alone.fits.filter(F.col("tier") == tier).collect():
            got = fits[tier, model, r.fold]
            assert got.n_train == r.n_train and len(got.weights) == len(r.weights) and got.converged == r.converged
            if model != "large_segment":
                assert np.allclose(got.weights, r.weights, rtol=1e-5)
        one = (F.col("tier") == tier) & (F.col("model") == model)
        expected = [r.projected_value for r in alone.projections.filter(F.col("tier") == tier).orderBy("date").collect()]
        assert [r.projected_value for r in out.projections.filter(one).orderBy("date").collect()] == pytest.approx(expected, rel=1e-5)
        assert out.performance.filter(one).first().r2 == pytest.approx(alone.performance.filter(F.col("tier") == tier).first().r2)
    assert {r.term for r in out.coefficients.filter("model = 'ending_mrr'").collect()} <= set(ENDING_MRR.features)
    assert out.trend.count() == 3 * (N - 1 + 3) and out.growth.count() == 3
    with pytest.raises(Exception, match="not a model: typo"):
        forecast_each(monthly, spark.createDataFrame([("Full", "typo")], "tier string, model string"))
    # the sums of products of all models are one aggregation
    plan = fit.moments(out.history.select("tier", "model", "fold", "terms", "centre", "target", "target_centre"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_scenarios_as_a_table(spark, monthly):
    rows = [("flat", "arpu", 1.0), ("fewer", "churn", 0.5), ("fewer", "expansion", None)]
    schema = "scenario string, feature string, end_multiplier double"
    out = forecast(monthly, ENDING_MRR, 3, scenario=spark.createDataFrame(rows, schema))
    assert out.fits.count() == len(TIERS) * 6
    for name, scenario in {"flat": {"arpu": 1.0}, "fewer": {"churn": 0.5}}.items():
        alone = forecast(monthly, ENDING_MRR, 3, scenario=scenario).projections
        expected = {(r.tier, r.month): r.trend for r in alone.collect()}
        got = {(r.tier, r.month): r.trend for r in out.projections.filter(F.col("scenario") == name).collect()}
        assert got == {k: pytest.approx(v) for k, v in expected.items()}
    assert out.growth.count() == 2 * len(TIERS)
    # the past belongs to no scenario
    assert out.combined.filter("scenario IS NULL").count() == out.history.count()
    none = forecast(monthly, ENDING_MRR, 3, scenario=spark.createDataFrame([], schema)).projections
    assert none.count() == 0
    for bad in ([("x", "typo", 2.0)], [("x", None, 2.0)], [("x", "arpu", 2.0), ("x", "arpu", 3.0)]):
        with pytest.raises(Exception, match="not a feature|DUPLICATED_MAP_KEY"):
            forecast(monthly, ENDING_MRR, 3, scenario=spark.createDataFrame(bad, schema)).projections.collect()


def test_coefficient_names(monthly):
    out = forecast(monthly, LARGE_SEGMENT, 2)
    names = fit.term_names(LARGE_SEGMENT)
    assert len(names) == 35 and names[7] == "month_sequential^2" and names[8] == "month_sequential month_number"
    assert {r.term for r in out.coefficients.collect()} <= set(names)
    assert all(abs(r.coefficient) > 0.01 for r in out.coefficients.collect())


def test_predictions_sink(spark, monthly, tmp_path):
    out = forecast(monthly, TREND, 2)
    path = sinks.write_predictions(out.trend, Layout(str(tmp_path)), "Ending MRR")
    assert path.endswith("forecasts/Ending_MRR_predictions")
    assert read_current(spark, path, ["Full"]).count() == N - 1 + 2
