"""SQL for the models with several features.

The minimum of the penalised objective is found by brute force: with the sign of every weight given
(-1, 0 or 1) the problem is a linear system, and the best of all 3**p solutions is the minimum, as
no weights can have a lower objective. Least squares is the one system without a penalty. Systems
are solved by elimination, one nested select per feature, so SQL shares nothing with the library's
search.

Models with too many patterns are fitted by descent in a recursive select: each turn sets the one
weight that lowers the objective most, then goes towards the solution for the present signs, as far
as no weight changes its sign. It ends when the duality gap, computed anew in each turn from the
moments, is at most ``GAP`` of the target's variance: then it is the optimum, however it was found.
"""

from __future__ import annotations

from verification.forecast_oracle import COMPLETE, FOLDS, HIGH, MODERATE, UNDER, tiers_of
from verification.forecast_queries import SCENARIO, SCENARIOS
from verification.oracle import BRIDGE, combined
from waterline.config import BAD_MONTHS, FULL, GOOD_MONTHS, SEGMENTS
from waterline.forecast.fit import REPORTED, term_names
from waterline.forecast.models import ENDING_MRR, LARGE_SEGMENT, NET_NEW_MRR, OLS, Model

# Share of the target's variance at which a descent ends, and the turns after which it does not.
GAP, TURNS = 1e-9, 300


def _finite(expression: str) -> str:
    return f"CASE WHEN isfinite(CAST({expression} AS DOUBLE)) THEN CAST({expression} AS DOUBLE) ELSE 0.0 END"


def _net_new() -> str:
    """``prepared``: the months with the features of the Net New model; needs ``complete`` and ``folds``."""
    quality = f"({HIGH}_new_mrr + {MODERATE}_new_mrr)"
    total = f"coalesce(nullif({quality} + {UNDER}_new_mrr, 0), 1.0)"
    return f"""{tiers_of("new_mrr")},
prepared AS (
  SELECT c.* REPLACE (coalesce(c.new_count, median(c.new_count) OVER (PARTITION BY c.tier)) AS new_count), f.fold,
    c.month_sequential * c.month_sequential AS month_sequential_squared, CAST(c.month_number > 6 AS INT) AS h2_indicator,
    CAST(c.month_number IN {tuple(GOOD_MONTHS)} AS INT) AS good_months, CAST(c.month_number IN {tuple(BAD_MONTHS)} AS INT) AS bad_months,
    {quality} / {total} AS quality_ratio, {UNDER}_new_mrr / {total} AS under_ratio, {quality} / {total} * {total} AS quality_weighted,
    CASE WHEN {HIGH}_new_mrr > -1 THEN ln(1 + {HIGH}_new_mrr) / ln(1 + abs({UNDER}_new_mrr) + 100) ELSE 0.0 END AS high_to_under
  FROM featured c JOIN folds f USING (tier, month))"""


def frame(model: Model) -> str:
    """``frame(tier, month, seq, x, y, fold)`` of complete months; needs ``combined``. ``x`` are the terms."""
    features = ", ".join(_finite(f) for f in model.features)
    first = ""
    if model is OLS:
        growth = ", ".join(
            f"coalesce(ending_mrr / nullif(lag(ending_mrr, {k}) OVER (PARTITION BY tier ORDER BY month), 0) - 1, 0.0) AS growth_{k}m"
            for k in (1, 3, 6)
        )
        source = f"(SELECT *, {growth} FROM folds)"
    elif model is NET_NEW_MRR:
        first, source = f",{_net_new()}", "prepared"
    else:
        source = "folds"
    return f"""{COMPLETE},{FOLDS}{first},
frame AS (
  SELECT tier, month, seq, fold, {_terms(model, "x")} AS x, x AS plain, y FROM (
    SELECT tier, month, month_sequential AS seq, fold, [{features}] AS x, {_finite(model.target)} AS y FROM {source}))"""


def _terms(model: Model, features: str) -> str:
    """The terms of a list of features: for degree 2 also their products."""
    n = len(model.features)
    products = ", ".join(f"({features})[{i}] * ({features})[{j}]" for i in range(1, n + 1) for j in range(i, n + 1))
    return features if model.degree == 1 else f"list_concat({features}, [{products}])"


def _moments(p: int, folds: bool) -> str:
    left_out = "(VALUES (-1), (0), (1), (2), (3), (4))" if folds else "(VALUES (-1))"
    means = ", ".join(f"avg(x[{i}])" for i in range(1, p + 1))
    # centred moments by a second pass; the last column is the target's
    z = ", ".join([f"(x[{i}] - m[{i}])" for i in range(1, p + 1)] + ["(y - my)"])
    rows = ", ".join("[" + ", ".join(f"avg(z[{i}] * z[{j}])" for j in range(1, p + 2)) + "]" for i in range(1, p + 1))
    return f"""
training AS (
  SELECT f.*, k.fold AS left_out FROM frame f, {left_out} AS k(fold) WHERE f.fold <> k.fold),
centres AS (
  SELECT tier, left_out, count(*) AS n_train, [{means}] AS m, avg(y) AS my FROM training GROUP BY ALL),
centred AS (
  SELECT tier, left_out, [{z}] AS z FROM training JOIN centres USING (tier, left_out)),
moments AS MATERIALIZED (
  SELECT tier, left_out AS fold, [{rows}] AS g, avg(z[{p + 1}] * z[{p + 1}]) AS yy FROM centred GROUP BY ALL)"""


_FITS = """
fits AS MATERIALIZED (
  SELECT b.tier, b.fold, n_train, w, my - list_dot_product(w, m) AS b
  FROM best b JOIN centres c ON c.tier = b.tier AND c.left_out = b.fold)"""


def fits(model: Model, folds: bool = True) -> str:
    """``fits(tier, fold, n_train, b, w)``: fold -1 is the model, 0 to 4 leave one out. Needs ``frame``."""
    p = len(term_names(model))
    if p > 6:
        return f"{_moments(p, folds)},{_descent(p, model.alpha)},{_FITS}"
    signs = "[-1, 0, 1]" if model.alpha else "[1]"
    patterns = ", ".join(f"s{i}" for i in range(1, p + 1))
    crossed = ", ".join(f"(SELECT unnest({signs}) AS s{i})" for i in range(1, p + 1))
    # a weight held at zero has the row of the unit matrix
    system = ", ".join(
        "[" + ", ".join(f"CASE WHEN s[{i}] = 0 THEN {1.0 if i == j else 0.0} ELSE g[{i}][{j}] END" for j in range(1, p + 1))
        + f", CASE WHEN s[{i}] = 0 THEN 0.0 ELSE g[{i}][{p + 1}] - {model.alpha} * s[{i}] END]"
        for i in range(1, p + 1)
    )
    solve = f"(SELECT tier, fold, s, [{system}] AS a FROM moments, patterns)"
    for k in range(1, p + 1):
        solve = f"""(SELECT tier, fold, s, list_transform(a, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / a[{k}][{k}])
            ELSE list_transform(r, lambda v, j: v - r[{k}] / a[{k}][{k}] * a[{k}][j]) END) AS a FROM {solve})"""
    weights = ", ".join(f"a[{i}][{p + 1}]" for i in range(1, p + 1))
    fit = " + ".join(f"w[{i}] * (" + " + ".join(f"g[{i}][{j}] * w[{j}]" for j in range(1, p + 1)) + f") / 2 - w[{i}] * g[{i}][{p + 1}]" for i in range(1, p + 1))
    penalty = " + ".join(f"abs(w[{i}])" for i in range(1, p + 1))
    return f"""{_moments(p, folds)},
patterns AS MATERIALIZED (SELECT [{patterns}] AS s FROM {crossed}),
solved AS (SELECT tier, fold, [{weights}] AS w FROM {solve}),
weighed AS (
  SELECT tier, fold, w, {fit} + {model.alpha} * ({penalty}) AS objective FROM solved JOIN moments USING (tier, fold)),
best AS (
  SELECT tier, fold, arg_min(w, objective) AS w FROM weighed WHERE isfinite(objective) GROUP BY ALL),{_FITS}"""


def _descent(p: int, alpha: float) -> str:
    """``best(tier, fold, w, gap)`` by descent; needs ``moments`` and a recursive WITH."""
    zero, one = "CAST(0 AS DOUBLE)", "CAST(1 AS DOUBLE)"
    kept = "tier, fold, g, yy, turn"
    # the best value of each weight with the others held, and the weight where that lowers the objective most
    single = f"""(SELECT {kept}, list_transform(w, lambda v, i: CASE WHEN i = k THEN alone[k] ELSE v END) AS w FROM (
      SELECT *, list_position(gain, list_max(gain)) AS k FROM (
      SELECT *, list_transform(alone, lambda v, i: g[i][i] * (v - w[i]) * (v - w[i])) AS gain FROM (
      SELECT *, list_transform(free, lambda f, i: CASE WHEN g[i][i] > 0 THEN sign(f) * greatest(abs(f) - {alpha}, 0) / g[i][i] ELSE {zero} END) AS alone FROM (
      SELECT *, list_transform(g, lambda r, i: r[{p + 1}] - list_dot_product(r[1:{p}], w) + r[i] * w[i]) AS free
      FROM descent WHERE gap > {GAP} AND turn < {TURNS})))))"""
    # the system of the present signs; rows and columns of weights at zero are left alone
    solve = f"""(SELECT {kept}, w, list_transform(g, lambda r, i: list_transform(r, lambda v, j: CASE WHEN j = {p + 1} THEN v - {alpha} * sign(w[i]) ELSE v END)) AS a
      FROM {single})"""
    for k in range(1, p + 1):
        solve = f"""(SELECT {kept}, w, CASE WHEN w[{k}] = 0 THEN a ELSE list_transform(a, lambda r, i: CASE
          WHEN i = {k} THEN list_transform(r, lambda v: v / a[{k}][{k}]) WHEN w[i] = 0 THEN r
          ELSE list_transform(r, lambda v, j: v - r[{k}] / a[{k}][{k}] * a[{k}][j]) END) END AS a FROM {solve})"""
    goal = f"(SELECT {kept}, w, list_transform(a, lambda r, i: CASE WHEN w[i] = 0 THEN {zero} ELSE r[{p + 1}] END) AS goal FROM {solve})"
    crosses = "v <> 0 AND v * goal[i] <= 0"
    # the part of the way until a weight reaches zero; that weight then is zero
    share = f"""(SELECT *, list_bool_and(list_transform(goal, lambda v: isfinite(v))) AS known,
      list_min(list_concat([{one}], list_transform(w, lambda v, i: CASE WHEN {crosses} THEN v / (v - goal[i]) ELSE {one} END))) AS share FROM {goal})"""
    moved = f"""(SELECT {kept}, CASE WHEN known THEN list_transform(w, lambda v, i: CASE WHEN {crosses} AND v / (v - goal[i]) = share THEN {zero}
      ELSE v + share * (goal[i] - v) END) ELSE w END AS w FROM {share})"""
    slopes = f"""(SELECT *, list_transform(g, lambda r: r[{p + 1}]) AS m,
      list_transform(g, lambda r: r[{p + 1}] - list_dot_product(r[1:{p}], w)) AS slope FROM {moved})"""
    # the residual, scaled until no slope exceeds the penalty, bounds the objective from below
    parts = f"""(SELECT *, list_sum(list_transform(w, lambda v: abs(v))) AS size, yy - list_dot_product(m, w) AS against,
      greatest(yy - list_dot_product(m, w) - list_dot_product(slope, w), 0) AS residual,
      least({one}, {alpha} / greatest(list_max(list_transform(slope, lambda v: abs(v))), 1e-300)) AS scaled FROM {slopes})"""
    gap = f"(residual / 2 + {alpha} * size - scaled * against + scaled * scaled * residual / 2) / yy"
    return f"""
descent AS (
  SELECT tier, fold, g, yy, 0 AS turn, list_transform(g, lambda r: {zero}) AS w, CASE WHEN yy > 0 THEN {one} ELSE {zero} END AS gap FROM moments
  UNION ALL
  SELECT tier, fold, g, yy, turn + 1, w, {gap} FROM {parts}),
best AS (SELECT tier, fold, arg_max(w, turn) AS w, arg_max(gap, turn) AS gap FROM descent GROUP BY ALL)"""


LAST = """
last_row AS (
  SELECT tier, max(month) AS month, max(seq) AS seq, arg_max(plain, month) AS x, arg_max(y, month) AS now FROM frame GROUP BY tier)"""


def ahead(model: Model, months: int = 12, scenario: dict[str, float] | None = None) -> str:
    """``ahead(tier, date, seq, now, trend, v)``; needs ``frame`` and ``fits``."""
    growth = {**model.growth, **(scenario or {})}
    moving = {
        "month_sequential": "CAST(seq AS DOUBLE)",
        "month_sequential_squared": "CAST(seq * seq AS DOUBLE)",
        "month_number": "CAST(month(date) AS DOUBLE)",
        "h2_indicator": "CAST(month(date) > 6 AS INT)",
        "good_months": f"CAST(month(date) IN {tuple(GOOD_MONTHS)} AS INT)",
        "bad_months": f"CAST(month(date) IN {tuple(BAD_MONTHS)} AS INT)",
    }
    features = ", ".join(
        moving.get(f, f"x[{i}] * (1 + ({growth.get(f, 1.0)} - 1) * (i - 1) / {max(1, months - 1)}.0)") for i, f in enumerate(model.features, 1)
    )
    value = "trend" if model.floor_share is None else f"greatest(trend, now * {model.floor_share})"
    return f"""{LAST},
steps AS (
  SELECT tier, last_day(CAST(concat(month, '-01') AS DATE) + CAST(i AS INT) * INTERVAL '1' MONTH) AS date, seq + i AS seq, now, x, i
  FROM last_row, range(1, {months + 1}) AS r(i)),
ahead AS (
  SELECT *, {value} AS v FROM (
    SELECT tier, date, seq, now, b + list_dot_product(w, {_terms(model, "x")}) AS trend
    FROM (SELECT * REPLACE ([{features}] AS x) FROM steps) JOIN fits USING (tier) WHERE fold = -1))"""


def digits(expression: str, name: str, count: int = 6) -> str:
    """Significant digits: sums of products differ in their last ones with the order of summation."""
    return f"CAST(format('{{:.{count - 1}e}}', CAST({expression} AS DOUBLE) + 0.0) AS DOUBLE) AS {name}"


def _weights(model: Model) -> str:
    return f"""WITH RECURSIVE {combined()},{frame(model)},{fits(model)}
        SELECT tier, CAST(fold AS BIGINT) AS fold, n_train, {digits('b', 'intercept', 5)},
          CAST(i - 1 AS BIGINT) AS position, {digits('w[i]', 'weight', 5)}
        FROM fits, range(1, {len(model.features) + 1}) AS r(i)"""


_PROJECTED = f"""SELECT tier, CAST(date AS VARCHAR) AS date, strftime(date, '%Y-%m') AS month, seq AS month_sequential,
  {digits('now', 'last_actual')}, {digits('trend', 'trend')}, {digits('v', 'projected_value')}"""


def _projection(model: Model, scenario: dict[str, float] | None = None) -> str:
    annual = digits("v * 12", "projected_arr") if model.annualise else "CAST(NULL AS DOUBLE) AS projected_arr"
    return f"WITH RECURSIVE {combined()},{frame(model)},{fits(model, folds=False)},{ahead(model, scenario=scenario)} {_PROJECTED}, {annual} FROM ahead"


def _growth(source: str, tiers: str = "true") -> str:
    return f"""WITH {source},{frame(ENDING_MRR)},{fits(ENDING_MRR, folds=False)},{ahead(ENDING_MRR)},
        ends AS (SELECT tier, count(*) AS months, max(now) AS now, arg_max(v, date) AS v FROM ahead GROUP BY tier)
        SELECT tier, months, {digits('now', 'current_value')}, {digits('v', 'projected_value')}, {digits('v * 12', 'projected_arr')},
          {digits("CASE WHEN now = 0 THEN 0.0 ELSE (v - now) / abs(now) * 100 END", 'total_growth')},
          {digits("CASE WHEN now <= 0 THEN 0.0 WHEN v >= 0 THEN pow(v / now, 1.0 / months) - 1 END", 'monthly_growth_rate')}
        FROM ends WHERE {tiers}"""


METRICS = f"""WITH {combined()},{frame(ENDING_MRR)},{fits(ENDING_MRR)},
errors AS (SELECT f.tier, f.fold, y, y - b - list_dot_product(w, x) AS e FROM frame f JOIN fits k ON k.tier = f.tier AND k.fold = -1),
cv AS (
  SELECT tier, avg(m) AS cv_mae FROM (
    SELECT f.tier, f.fold, avg(abs(y - b - list_dot_product(w, x))) AS m
    FROM frame f JOIN fits k ON k.tier = f.tier AND k.fold = f.fold GROUP BY ALL) GROUP BY tier)
SELECT tier, count(*) AS n_months, {digits('1 - sum(e * e) / (var_pop(y) * count(*))', 'r2')}, {digits('avg(abs(e))', 'mae')},
  {digits('sqrt(avg(e * e))', 'rmse')}, {digits('max(cv_mae)', 'cv_mae')}
FROM errors JOIN cv USING (tier) GROUP BY tier"""


def _reached(model: Model) -> str:
    """The objective of every fit as a share of its target's variance, from the months themselves."""
    error = "y - my - list_dot_product(w, list_transform(x, lambda v, i: v - m[i]))"
    size = "list_sum(list_transform(any_value(w), lambda v: abs(v)))"
    return f"""SELECT '{model.name}' AS model, tier, left_out AS fold, round(share, 7) AS share, gap <= 1e-6 AS converged FROM (
      WITH RECURSIVE {frame(model)},{_moments(len(term_names(model)), True)},{_descent(len(term_names(model)), model.alpha)}
      SELECT t.tier, t.left_out, any_value(gap) AS gap, (avg(({error}) ** 2) / 2 + {model.alpha} * {size}) / var_pop(y) AS share
      FROM training t JOIN centres c ON c.tier = t.tier AND c.left_out = t.left_out JOIN best b ON b.tier = t.tier AND b.fold = t.left_out
      GROUP BY ALL)"""


def _dispatched() -> str:
    """The full set by the Net New model, all other series by Ending MRR."""
    parts = [
        f"""SELECT '{model.name}' AS model, tier, strftime(date, '%Y-%m') AS month, {digits('v', 'projected_value')} FROM (
          WITH RECURSIVE {frame(model)},{fits(model, folds=False)},{ahead(model)} SELECT * FROM ahead) WHERE tier {which} '{FULL}'"""
        for model, which in ((NET_NEW_MRR, "="), (ENDING_MRR, "<>"))
    ]
    return f"WITH {combined()} {' UNION ALL '.join(parts)}"


def _scenarios() -> str:
    parts = [
        f"""SELECT '{name}' AS scenario, * FROM (WITH {ahead(ENDING_MRR, scenario=scenario)} {_PROJECTED}, {digits('v * 12', 'projected_arr')} FROM ahead)"""
        for name, scenario in SCENARIOS.items()
    ]
    return f"WITH {combined()},{frame(ENDING_MRR)},{fits(ENDING_MRR, folds=False)} {' UNION ALL '.join(parts)}"


def _report(model: Model) -> str:
    names = ", ".join(f"'{n}'" for n in term_names(model))
    return f"""WITH RECURSIVE {combined()},{frame(model)},{fits(model, folds=False)}
        SELECT tier, [{names}][i] AS term, {digits('w[i]', 'coefficient', 5)}
        FROM fits, range(1, {len(term_names(model)) + 1}) AS r(i) WHERE abs(w[i]) > {REPORTED}"""


def oracle_sql() -> dict[str, str]:
    segments = ", ".join(f"('segment_{s:02d}', {s})" for s in SEGMENTS)
    by_segment = combined().replace(BRIDGE, f"bridge(tier, cxn_code) AS (VALUES {segments})")
    return {
        "fit_gaps": f"WITH {combined()} " + " UNION ALL ".join(_reached(m) for m in (ENDING_MRR, NET_NEW_MRR, LARGE_SEGMENT)),
        "lasso_ending": _weights(ENDING_MRR),
        "lasso_net_new": _weights(NET_NEW_MRR),
        "coefficient_report": _report(NET_NEW_MRR),
        "net_new_projection": _projection(NET_NEW_MRR),
        "model_dispatch": _dispatched(),
        "scenario_table": _scenarios(),
        "ols_baseline": _weights(OLS),
        "fit_metrics": METRICS,
        "projection": _projection(ENDING_MRR),
        "scenario_projection": _projection(ENDING_MRR, SCENARIO),
        "ols_projection": _projection(OLS),
        "growth_summary": _growth(combined()),
        "segment_forecast": _growth(by_segment, "tier <> 'Full'"),
    }
