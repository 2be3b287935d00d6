"""SQL for the feature queries and for the models SQL can fit itself."""

from __future__ import annotations

from verification.oracle import combined

HIGH, MODERATE, UNDER = "high_performers", "moderate_performers", "underperformers"

COMPLETE = """
complete AS (SELECT * FROM combined QUALIFY month < max(month) OVER (PARTITION BY tier))"""


def tiers_of(column: str) -> str:
    """Needs ``complete``."""
    sums = ", ".join(
        f"coalesce(sum({column}) FILTER (tier = '{t}'), 0.0) AS {t}_{column}"
        for t in (HIGH, MODERATE, UNDER)
    )
    names = ", ".join(f"coalesce({t}_{column}, 0.0) AS {t}_{column}" for t in (HIGH, MODERATE, UNDER))
    return f"""
per_month AS (SELECT month, {sums} FROM complete GROUP BY month),
featured AS (SELECT c.*, {names} FROM complete c LEFT JOIN per_month USING (month))"""


# Closed forms for one feature: least squares and its soft-thresholded version.
def _line(alpha: float) -> str:
    moment = "covar_pop(ending_mrr, month_sequential)"
    soft = f"sign({moment}) * greatest(abs({moment}) - {alpha}, 0)"
    return f"""
line AS (
  SELECT tier, count(*) AS n_train, {soft} / var_pop(month_sequential) AS slope,
    avg(ending_mrr) - {soft} / var_pop(month_sequential) * avg(month_sequential) AS intercept
  FROM complete GROUP BY tier)"""


LAST = """
last_row AS (
  SELECT tier, max(month) AS month, max(month_sequential) AS seq, arg_max(ending_mrr, month) AS now
  FROM complete GROUP BY tier)"""


def _ahead(months: int) -> str:
    return f"""
ahead AS (
  SELECT l.tier, last_day(CAST(concat(month, '-01') AS DATE) + CAST(i AS INT) * INTERVAL '1' MONTH)
      AS date, seq + i AS month_sequential, now, intercept + slope * (seq + i) AS v
  FROM last_row l JOIN line USING (tier), range(1, {months + 1}) AS r(i))"""


FOLDS = """
folds AS (SELECT *, ntile(5) OVER (PARTITION BY tier ORDER BY month) - 1 AS fold FROM complete)"""


def _gram() -> str:
    columns = [
        "month_sequential", "month_number", "new_count", "churn_count", "ending_count", "net_count",
    ]
    z = ["1.0"] + [f"({c} - avg({c}) OVER (PARTITION BY tier))" for c in columns]
    picked = ", ".join(f"CAST({e} AS DOUBLE) AS z{i}" for i, e in enumerate(z))
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    parts = " UNION ALL ".join(
        f"SELECT tier, CAST(fold AS BIGINT) AS fold, CAST({pos} AS BIGINT) AS pos,"
        f" round(sum(z{i} * z{j}), 3) AS value FROM z GROUP BY ALL"
        for pos, (i, j) in enumerate(pairs)
    )
    return f"WITH {combined()},{COMPLETE},{FOLDS}, z AS (SELECT tier, fold, {picked} FROM folds) {parts}"


def oracle_sql() -> dict[str, str]:
    base = f"WITH {combined()},{COMPLETE}"
    trend = f"{base},{_line(0)}"
    ahead12 = f"{trend},{LAST},{_ahead(12)}"
    total = f"({HIGH}_net_new_mrr + {MODERATE}_net_new_mrr + {UNDER}_net_new_mrr)"
    growth = ", ".join(
        f"coalesce(ending_mrr / nullif(lag(ending_mrr, {k}) OVER w, 0) - 1, 0.0) AS growth_{k}m"
        for k in (1, 3, 6)
    )
    high, under = f"{HIGH}_net_new_mrr", f"{UNDER}_net_new_mrr"
    return {
        "calendar_features": f"""{base}
            SELECT tier, month, month_number,
              CAST(quarter(CAST(concat(month, '-01') AS DATE)) AS BIGINT) AS quarter,
              CAST(month_number > 6 AS BIGINT) AS h2_indicator,
              CAST(month_number IN (3, 5, 6) AS BIGINT) AS good_months,
              CAST(month_number IN (7, 8, 10, 12) AS BIGINT) AS bad_months,
              CAST(month_sequential AS DOUBLE) AS month_sequential,
              CAST(month_sequential * month_sequential AS DOUBLE) AS month_sequential_squared
            FROM complete""",
        "tier_features": f"{base},{tiers_of('new_mrr')} SELECT tier, month, {HIGH}_new_mrr,"
        f" {MODERATE}_new_mrr, {UNDER}_new_mrr FROM featured",
        "quality_ratios": f"""{base},{tiers_of('net_new_mrr')}
            SELECT tier, month, t AS total_segment_mrr, q / t AS quality_ratio,
              {under} / t AS under_ratio, q / t * t AS quality_weighted
            FROM (SELECT *, {HIGH}_net_new_mrr + {MODERATE}_net_new_mrr AS q,
                    CASE WHEN {total} = 0 THEN 1.0 ELSE {total} END AS t FROM featured)""",
        "high_to_under": f"""{base},{tiers_of('net_new_mrr')}
            SELECT tier, month, round({high} / (abs({under}) + 100), 9) AS linear,
              round(CASE WHEN {high} > -1 THEN ln(1 + {high}) / ln(1 + abs({under}) + 100)
                ELSE 0.0 END, 9) AS log
            FROM featured""",
        "growth_rates": f"{base} SELECT tier, month, {growth} FROM complete"
        " WINDOW w AS (PARTITION BY tier ORDER BY month)",
        "gram_stats": _gram(),
        "ols_trend": f"""{base}
            SELECT tier, count(*) AS n_train,
              round(regr_intercept(ending_mrr, month_sequential), 4) AS intercept,
              round(regr_slope(ending_mrr, month_sequential), 4) AS slope
            FROM complete GROUP BY tier""",
        "lasso_trend": f"{base},{_line(15)} SELECT tier, n_train, round(intercept, 4) AS intercept,"
        " round(slope, 4) AS slope FROM line",
        "trend_quality": f"""{trend},{FOLDS},
            others AS (
              SELECT f.tier, k.fold, regr_slope(ending_mrr, month_sequential) AS slope,
                regr_intercept(ending_mrr, month_sequential) AS intercept
              FROM folds f JOIN (SELECT DISTINCT tier, fold FROM folds) k
                ON k.tier = f.tier AND k.fold <> f.fold
              GROUP BY ALL),
            cv AS (
              SELECT tier, avg(m) AS cv_mae
              FROM (SELECT f.tier, f.fold,
                      avg(abs(ending_mrr - intercept - slope * month_sequential)) AS m
                    FROM folds f JOIN others USING (tier, fold) GROUP BY ALL)
              GROUP BY tier)
            SELECT c.tier, count(*) AS n_months,
              round(regr_r2(ending_mrr, month_sequential), 8) AS r2,
              round(avg(abs(ending_mrr - intercept - slope * month_sequential)), 4) AS mae,
              round(sqrt(avg((ending_mrr - intercept - slope * month_sequential) ** 2)), 4) AS rmse,
              round(max(cv_mae), 4) AS cv_mae
            FROM complete c JOIN line USING (tier) JOIN cv USING (tier) GROUP BY c.tier""",
        "trend_projection": f"""{trend},{LAST},{_ahead(24)}
            SELECT tier, CAST(date AS VARCHAR) AS date, strftime(date, '%Y-%m') AS month,
              month_sequential, round(v, 4) AS projected_value, round(v * 12, 4) AS projected_arr
            FROM ahead""",
        "trend_table": f"""{ahead12}
            SELECT tier, concat(month, '-01') AS month, round(ending_mrr, 4) AS historical_data,
              CAST(NULL AS DOUBLE) AS projected_data,
              round(intercept + slope * month_sequential, 4) AS model_trend_line
            FROM complete JOIN line USING (tier)
            UNION ALL
            SELECT tier, CAST(date AS VARCHAR), CAST(NULL AS DOUBLE), round(v, 4), round(v, 4)
            FROM ahead""",
        "typed_history": f"""{ahead12}
            SELECT tier, concat(month, '-01') AS month, month_sequential,
              round(ending_mrr, 4) AS mrr, 'Historical' AS type FROM complete
            UNION ALL
            SELECT tier, CAST(date AS VARCHAR), month_sequential, round(v, 4), 'Projected'
            FROM ahead""",
        "trend_growth_summary": f"""{ahead12}
            SELECT tier, count(*) AS months, round(max(now), 4) AS current_value,
              round(arg_max(v, date), 4) AS projected_value,
              round(arg_max(v, date) * 12, 4) AS projected_arr,
              round(CASE WHEN max(now) = 0 THEN 0.0
                ELSE (arg_max(v, date) - max(now)) / abs(max(now)) * 100 END, 4) AS total_growth,
              round(CASE WHEN max(now) <= 0 THEN 0.0
                WHEN arg_max(v, date) >= 0
                  THEN pow(arg_max(v, date) / max(now), 1.0 / count(*)) - 1 END, 9)
                AS monthly_growth_rate
            FROM ahead GROUP BY tier""",
    }
