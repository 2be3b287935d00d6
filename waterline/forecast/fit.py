"""Fitting one linear model per series.

Everything a fit needs of the data are sums of products. Spark adds those up per series and
cross-validation fold; only the small matrices reach Python, one series at a time.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.forecast.models import Model
from waterline.forecast.solver import GAP, fit_from_moments

FOLDS = 5
ALL = -1  # the fold id of the fit on all rows
REPORTED = 0.01  # coefficients up to this size are left out of the report

# What tells series apart: a tier, fitted by one of several models, projected under one of several scenarios.
KEYS = ("tier", "model", "scenario")
_MODEL_SCHEMA = "fold int, n_train bigint, intercept double, weights array<double>, gap double, converged boolean"


def keys(df: DataFrame) -> list[str]:
    """The columns of ``KEYS`` that ``df`` has."""
    return [k for k in KEYS if k in df.columns]


def term_names(model: Model) -> list[str]:
    names = list(model.features)
    if model.degree == 2:
        names += [
            f"{a}^2" if a == b else f"{a} {b}"
            for a, b in combinations_with_replacement(model.features, 2)
        ]
    return names


def terms(model: Model) -> Column:
    """The features and, for degree 2, all their products, as one array."""
    values = [F.col(c).cast("double") for c in model.features]
    if model.degree == 2:
        values += [a * b for a, b in combinations_with_replacement(values, 2)]
    return F.array(*values)


def _fold(position: Column, n: Column) -> Column:
    """Contiguous folds; the first ``n % 5`` hold one row more."""
    size, larger = F.floor(n / FOLDS), n % FOLDS
    in_larger = position < larger * (size + 1)
    return F.when(in_larger, F.floor(position / (size + 1))).otherwise(
        larger + F.floor(F.try_divide(position - larger * (size + 1), size))
    )


def design(frame: DataFrame, model: Model) -> DataFrame:
    """``(tier, month, month_sequential, fold, terms, target)`` plus the series' centre.

    A series has one row per month, so windows over it stay short.
    """
    series = Window.partitionBy("tier")
    order = series.orderBy("month")
    rows = frame.select(
        "tier",
        "month",
        "month_sequential",
        (F.row_number().over(order) - 1).alias("position"),
        F.count("*").over(series).alias("n"),
        terms(model).alias("terms"),
        F.col(model.target).cast("double").alias("target"),
    )
    width = len(term_names(model))
    centre = [F.avg(F.col("terms")[i]).over(series) for i in range(width)]
    return rows.select(
        "tier",
        "month",
        "month_sequential",
        _fold(F.col("position"), F.col("n")).cast("int").alias("fold"),
        "terms",
        "target",
        F.array(*centre).alias("centre"),
        F.avg("target").over(series).alias("target_centre"),
    )


def moments(rows: DataFrame) -> DataFrame:
    """``(tier, fold, pos, value)``: sums of products of ``(1, x..., y)``, upper triangle by rows.

    Series may have different numbers of terms.
    """
    series = keys(rows)
    centred = F.zip_with("terms", "centre", lambda x, c: x - c)
    z = F.concat(
        F.array(F.lit(1.0)), centred, F.array(F.col("target") - F.col("target_centre"))
    )
    products = F.flatten(
        F.transform(
            "z",
            lambda a, i: F.transform(
                F.slice("z", i + 1, F.size("z") - i), lambda b: a * b
            ),
        )
    )
    return (
        rows.select(*series, "fold", z.alias("z"))
        .select(*series, "fold", F.posexplode(products).alias("pos", "value"))
        .groupBy(*series, "fold", "pos")
        .agg(F.sum("value").alias("value"))
    )


def _solve(series: list[str], alphas: dict[str, float]):
    """``alphas`` by model; series without the column ``model`` all have the only one."""

    def matrix(values, side: int) -> np.ndarray:
        m = np.zeros((side, side))
        m[np.triu_indices(side)] = values
        return m + np.triu(m, 1).T

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        centre = np.asarray(group["centre"].iloc[0], dtype=float)
        per_fold = {
            int(fold): matrix(rows.sort_values("pos")["value"].to_numpy(), len(centre) + 2)
            for fold, rows in group.groupby("fold")
        }
        own = [group[k].iloc[0] for k in series]
        alpha = alphas[group["model"].iloc[0]] if "model" in series else next(iter(alphas.values()))
        target_centre = float(group["target_centre"].iloc[0])
        total = sum(per_fold.values())
        training = {ALL: total}
        if len(per_fold) == FOLDS:
            training |= {fold: total - part for fold, part in per_fold.items()}
        out = []
        for fold, m in training.items():
            intercept, weights, gap = fit_from_moments(m, alpha)
            shifted = intercept + target_centre - float(weights @ centre)
            out.append((*own, fold, round(m[0, 0]), shifted, weights.tolist(), gap, gap <= GAP))
        return pd.DataFrame(out, columns=[*series, "fold", "n_train", "intercept", "weights", "gap", "converged"])

    return solve


def fit(rows: DataFrame, *models: Model) -> DataFrame:
    """``(tier, fold, n_train, intercept, weights, gap, converged)``: fold -1 is the model, 0..4 leave one out.

    ``gap`` bounds how far the objective is from its optimum, as a share of the target's variance.
    Cross-validation fits need no second pass: their sums are the total less the fold's own. With
    several ``models`` the column ``model`` of ``rows`` names each series' own, and the fits carry it.
    """
    series = keys(rows)
    centres = rows.groupBy(*series).agg(
        F.first("centre").alias("centre"), F.first("target_centre").alias("target_centre")
    )
    # width * width / 2 numbers per fold: a group's size is set by the model, not by the data
    grouped = moments(rows).join(centres, series).groupBy(*series)
    schema = ", ".join([*(f"{k} string" for k in series), _MODEL_SCHEMA])
    return grouped.applyInPandas(_solve(series, {m.name: m.alpha for m in models}), schema=schema)


def predict(values: Column) -> Column:
    """Intercept plus weights times ``values``."""
    products = F.zip_with("weights", values, lambda w, x: w * x)
    return F.aggregate(products, F.col("intercept"), lambda acc, p: acc + p)


def whole(fits: DataFrame) -> DataFrame:
    return fits.filter(F.col("fold") == ALL).drop("fold")


def fitted(rows: DataFrame, fits: DataFrame) -> DataFrame:
    return rows.join(whole(fits), keys(fits)).withColumn("prediction", predict(F.col("terms")))


def quality(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """``(tier, n_months, r2, mae, rmse, cv_mae)``."""
    series = keys(rows)
    error = F.col("target") - F.col("prediction")
    spread = F.col("target") - F.col("target_centre")
    inside = (
        fitted(rows, fits)
        .groupBy(*series)
        .agg(
            F.count("*").alias("n_months"),
            F.sum(error * error).alias("sse"),
            F.sum(spread * spread).alias("sst"),
            F.avg(F.abs(error)).alias("mae"),
        )
    )
    held_out = (
        rows.join(fits, [*series, "fold"])
        .withColumn("prediction", predict(F.col("terms")))
        .groupBy(*series, "fold")
        .agg(F.avg(F.abs(error)).alias("fold_mae"))
        .groupBy(*series)
        .agg(F.avg("fold_mae").alias("cv_mae"))
    )
    constant = F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
    return inside.join(held_out, series, "left").select(
        *series,
        "n_months",
        F.when(F.col("sst") == 0, constant)
        .otherwise(1 - F.try_divide("sse", "sst"))
        .alias("r2"),
        "mae",
        F.sqrt(F.col("sse") / F.col("n_months")).alias("rmse"),
        "cv_mae",
    )


def coefficients(fits: DataFrame, *models: Model, above: float = REPORTED) -> DataFrame:
    """``(tier, term, coefficient)`` of the terms that matter; with ``model`` where ``fits`` has it."""
    series = keys(fits)
    names = {m.name: F.array(*[F.lit(n) for n in term_names(m)]) for m in models}
    if "model" in series:
        own = F.get(F.create_map(*[c for n, a in names.items() for c in (F.lit(n), a)])[F.col("model")], F.col("pos"))
    else:
        own = F.get(next(iter(names.values())), F.col("pos"))
    return (
        whole(fits)
        .select(*series, F.posexplode("weights").alias("pos", "coefficient"))
        .filter(F.abs("coefficient") > above)
        .select(*series, own.alias("term"), "coefficient")
    )
