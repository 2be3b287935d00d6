"""Minimising a penalised least-squares objective given its sufficient statistics.

The penalised form is solved by searching over the signs of the weights: with the signs fixed the
problem is linear, and a step never crosses a sign change that raises the objective. Every step
lowers the objective, so the search ends; where rounding ends it before the optimum, cyclic
coordinate descent goes on from there while it helps. How far the result can be from the optimum is
returned with it: the duality gap, as a share of the target's variance.
"""

from __future__ import annotations

import numpy as np

SLACK = 1e-9
# A fit has converged if the gap is at most this share of the target's variance.
GAP = 1e-6


def _linear(system: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(system, right, rcond=1e-13)[0]


def _objective(gram, moment, penalty, weights) -> float:
    return weights @ gram @ weights / 2 - moment @ weights + penalty @ np.abs(weights)


def _descend(gram, moment, penalty, weights):
    """Coordinate descent while a round lowers the objective by more than rounding could."""
    weights, value = weights.copy(), _objective(gram, moment, penalty, weights)
    while True:
        for j in range(len(weights)):
            free = moment[j] - gram[j] @ weights + gram[j, j] * weights[j]
            weights[j] = np.sign(free) * max(abs(free) - penalty[j], 0.0) / gram[j, j]
        now = _objective(gram, moment, penalty, weights)
        if value - now <= SLACK * abs(value):
            return weights
        value = now


def _best_step(gram, moment, penalty, weights, goal):
    """The lowest objective among ``goal`` and the sign changes on the way to it."""
    change = goal - weights
    with np.errstate(divide="ignore", invalid="ignore"):
        shares = -weights / change
    shares = shares[np.isfinite(shares) & (shares > 0) & (shares < 1)]
    best, lowest = weights, np.inf
    for share in [*shares, 1.0]:
        point = weights + share * change
        # A weight at its sign change is zero, not a rounding error away from it.
        point[np.abs(point) <= 1e-13 * np.abs(change)] = 0.0
        value = _objective(gram, moment, penalty, point)
        if value < lowest:
            best, lowest = point, value
    return best


def minimise(gram: np.ndarray, moment: np.ndarray, alpha: float) -> np.ndarray:
    """``argmin w'Gw/2 - m'w + alpha*|w|`` for centred second moments ``G`` and ``m``."""
    spread = np.sqrt(np.maximum(np.diag(gram), 0.0))
    out = np.zeros(len(moment))
    used = spread > 1e-12 * max(spread.max(initial=0.0), 1e-300)
    if not used.any():
        return out
    # Standardised, so that units do not decide what counts as singular.
    scale = spread[used]
    g, m = gram[np.ix_(used, used)] / np.outer(scale, scale), moment[used] / scale
    if alpha == 0:
        out[used] = _linear(g, m) / scale
        return out
    penalty = alpha / scale
    tolerance = SLACK * (penalty + np.abs(m).max())
    weights = np.zeros(len(m))
    signs = np.zeros(len(m))
    lowest = 0.0
    while True:
        slope = g @ weights - m
        active = weights != 0
        settled = np.all(np.abs(slope + penalty * signs)[active] <= tolerance[active])
        if settled:
            excess = np.where(active, -np.inf, np.abs(slope) - penalty - tolerance)
            entering = int(np.argmax(excess))
            if excess[entering] <= 0:
                break
            signs[entering] = -np.sign(slope[entering])
            active[entering] = True
        goal = np.zeros(len(m))
        goal[active] = _linear(g[np.ix_(active, active)], (m - penalty * signs)[active])
        moved = _best_step(g, m, penalty, weights, goal)
        value = _objective(g, m, penalty, moved)
        if value >= lowest:
            # no step helps any more
            weights = _descend(g, m, penalty, weights)
            break
        weights, signs, lowest = moved, np.sign(moved), value
    out[used] = weights / scale
    return out


def duality_gap(gram: np.ndarray, moment: np.ndarray, variance: float, weights: np.ndarray, alpha: float) -> float:
    """Bound on the distance from the lowest objective, as a share of the target's variance.

    The residual, scaled until no feature's moment with it exceeds ``alpha``, gives a lower bound.
    Without a penalty the moments themselves say how far the normal equations are from holding.
    """
    if variance <= 0:
        return 0.0
    slope = moment - gram @ weights
    residual = max(variance - 2 * moment @ weights + weights @ gram @ weights, 0.0)
    if alpha == 0:
        spread = np.sqrt(np.maximum(np.diag(gram), 0.0))
        known = spread > 0
        return float(np.abs(slope[known] / spread[known]).max(initial=0.0) / np.sqrt(variance))
    share = min(1.0, alpha / max(np.abs(slope).max(initial=0.0), 1e-300))
    against = variance - moment @ weights
    lower = share * against - share * share * residual / 2
    return float(max(residual / 2 + alpha * np.abs(weights).sum() - lower, 0.0) / variance)


def fit_from_moments(moments: np.ndarray, alpha: float) -> tuple[float, np.ndarray, float]:
    """Intercept, weights and gap from the sums of products of ``(1, x..., y)``."""
    n = moments[0, 0]
    means = moments[0, 1:] / n
    centred = moments[1:, 1:] / n - np.outer(means, means)
    gram, moment = centred[:-1, :-1], centred[:-1, -1]
    weights = minimise(gram, moment, alpha)
    gap = duality_gap(gram, moment, centred[-1, -1], weights, alpha)
    return float(means[-1] - weights @ means[:-1]), weights, gap
