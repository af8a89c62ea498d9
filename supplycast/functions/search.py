"""Parameter search of exponential smoothing for one series (numpy).

All grid points run side by side: the time loop advances vectors over the grid.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these helpers with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALPHA = (0.02, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95)
BETA_SHARE = (0.01, 0.1, 0.3, 0.7)
GAMMA_SHARE = (0.01, 0.1, 0.3, 0.7)
DAMPING = (0.8, 0.9, 0.98)


def _best_starts(y, alpha, beta, phi):
    """Squared error of every weight pair with its least-squares start.

    One-step errors are linear in the start, so the recursion carries them for
    a zero start together with their sensitivities to level and trend.
    """
    level, trend = np.zeros((3, len(alpha))), np.zeros((3, len(alpha)))
    level[1], trend[2] = 1.0, 1.0
    errors = np.empty((len(y), *level.shape))
    for t, value in enumerate(y):
        forecast = level + phi * trend
        error = -forecast
        error[0] += value
        errors[t] = error
        level = forecast + alpha * error
        trend = phi * trend + beta * error
    s = np.einsum("tig,tjg->ijg", errors, errors)
    det = s[1, 1] * s[2, 2] - s[1, 2] ** 2
    usable = det > 1e-12 * np.maximum(s[1, 1] * s[2, 2], 1e-300)
    det = np.where(usable, det, 1.0)
    start_level = np.where(usable, (s[0, 2] * s[1, 2] - s[0, 1] * s[2, 2]) / det, y[0])
    start_trend = np.where(usable, (s[0, 1] * s[1, 2] - s[0, 2] * s[1, 1]) / det, 0.0)
    start = np.stack([np.ones_like(det), start_level, start_trend])
    sse = np.einsum("ig,ijg,jg->g", start, s, start)
    return np.maximum(sse, 0.0), start_level, start_trend


def damped_trend(y, phi, points=9, rounds=4):
    """(alpha, beta, level, trend) with the least squared one-step error, beta <= alpha.

    A series with gaps has none.
    """
    y = np.asarray(y, float)
    if not len(y) or np.isnan(y).any():
        return (None,) * 4
    centre_a = centre_s = 0.5
    half = 0.4999
    best = None
    for _ in range(rounds):
        step = half * np.linspace(-1, 1, points)
        a = np.clip(centre_a + step, 1e-4, 0.9999)
        share = np.clip(centre_s + step, 1e-4, 0.9999)
        alpha, share = (g.ravel() for g in np.meshgrid(a, share, indexing="ij"))
        sse, level, trend = _best_starts(y, alpha, alpha * share, phi)
        i = int(sse.argmin())
        if best is None or sse[i] < best[0]:
            best = (sse[i], alpha[i], alpha[i] * share[i], level[i], trend[i])
            centre_a, centre_s = alpha[i], share[i]
        half *= 2.2 / (points - 1)
    return tuple(float(v) for v in best[1:])


def _line_and_figure(y, trend, season, freq):
    """Level and slope before the first value and the season, all from the whole series."""
    x = np.arange(1, len(y) + 1)
    slope = np.polyfit(x, y, 1)[0] if trend != "N" and len(y) > 1 else 0.0
    level = y.mean() - slope * x.mean()
    if season == "N":
        return level, slope, np.zeros(1)
    line = y.mean() + np.polyfit(x, y, 1)[0] * (x - x.mean())
    parts = y - line if season == "A" else y / line
    figure = np.bincount((x - 1) % freq, parts) / np.bincount((x - 1) % freq)
    return level, slope, figure - figure.mean() if season == "A" else figure / figure.mean()


def _grid(trend, season):
    """Columns alpha, beta, gamma, phi of all weight combinations."""
    axes = (
        ALPHA,
        BETA_SHARE if trend != "N" else (0.0,),
        GAMMA_SHARE if season != "N" else (0.0,),
        DAMPING if trend == "Ad" else (1.0,),
    )
    alpha, beta, gamma, phi = (g.ravel() for g in np.meshgrid(*axes, indexing="ij"))
    return alpha, alpha * beta, (1 - alpha) * gamma, phi


def _smooth(y, phases, weights, level, slope, figure, season):
    """States after the last value and error sums of the whole grid; ``figure`` is updated."""
    alpha, beta, gamma, phi = weights
    sse, relative, logs = np.zeros((3, len(alpha)))
    for value, phase in zip(y, phases):
        base = level + phi * slope
        s = figure[phase]
        forecast = {"N": base, "A": base + s, "M": base * s}[season]
        error = value - forecast
        pull = error / s if season == "M" else error
        if season != "N":
            figure[phase] = s + gamma * (error / base if season == "M" else error)
        level, slope = base + alpha * pull, phi * slope + beta * pull
        sse += error**2
        relative += (error / forecast) ** 2
        logs += np.log(np.abs(forecast))
    return level, slope, sse, relative, logs


def _run_form(y, trend, season, freq):
    """Final states and error sums of one trend and season form over its grid.

    Start states are backcast: each grid point first smooths the reversed series, which begins at
    the far end of the line through all values, and the states it reaches before the first value,
    with the slope turned round, are those the forward pass starts from.
    """
    weights = _grid(trend, season)
    size, phi = len(weights[0]), weights[3]
    level, slope, figure = _line_and_figure(y, trend, season, freq)
    phases = np.arange(len(y)) % len(figure)
    figure = np.tile(figure[:, None], size)
    far = np.full(size, level + slope * (len(y) + 1))
    level, slope, *_ = _smooth(
        y[::-1], phases[::-1], weights, far, np.full(size, -slope), figure, season
    )
    level, slope = level + phi * slope, -slope
    level, slope, sse, relative, logs = _smooth(
        y, phases, weights, level, slope, figure, season
    )
    # the next period's phase first
    figure = np.roll(figure, -(len(y) % len(figure)), axis=0)
    return weights, level, slope, figure, sse, relative, logs


def automatic(y, freq):
    """Form and weights with the least corrected AIC, as a dict.

    Seasonal forms need two whole cycles; multiplicative ones need positive
    values.  An additive error is not combined with a
    multiplicative season.  Empty for a series too short or with gaps.
    """
    y = np.asarray(y, float)
    if np.isnan(y).any():
        return {}
    n, positive = len(y), bool((y > 0).all())
    seasons = "NAM" if freq > 1 and n >= 2 * freq else "N"
    best = None
    with np.errstate(all="ignore"):
        for trend in ("N", "A", "Ad"):
            for season in seasons:
                if season == "M" and not positive:
                    continue
                weights, level, slope, figure, sse, relative, logs = _run_form(
                    y, trend, season, freq
                )
                k = 3 + {"N": 0, "A": 2, "Ad": 3}[trend] + (freq if season != "N" else 0)
                if n <= k + 1:
                    continue
                penalty = 2 * k + 2 * k * (k + 1) / (n - k - 1)
                for error in "AM":
                    if (error == "A" and season == "M") or (error == "M" and not positive):
                        continue
                    spread = sse if error == "A" else relative
                    lik = n * np.log(np.maximum(spread, 1e-300))
                    aicc = np.nan_to_num(
                        lik + (2 * logs if error == "M" else 0) + penalty, nan=np.inf
                    )
                    i = int(aicc.argmin())
                    if best is None or aicc[i] < best["aicc"]:
                        best = {
                            "model": f"ETS({error},{trend},{season})",
                            "aicc": float(aicc[i]),
                            **dict(zip(("alpha", "beta", "gamma", "phi"), (w[i] for w in weights))),
                            "level": level[i],
                            "trend": slope[i],
                            "season": figure[:, i].tolist() if season != "N" else [],
                            "sigma2": spread[i] / max(n - k + 1, 1),
                        }
    return best or {}
