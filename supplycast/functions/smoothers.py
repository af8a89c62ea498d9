"""Local regression smoothers for one equally spaced series (numpy)."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these helpers with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def loess(x: np.ndarray, y: np.ndarray, at: np.ndarray, span: float, degree: int, robust=None):
    """Local regression with tricube weights over the ``span`` nearest points."""
    weights = np.ones(len(x)) if robust is None else robust
    distance = np.abs(at[:, None] - x[None, :])
    reach = np.partition(distance, min(int(span), len(x)) - 1, axis=1)
    reach = reach[:, min(int(span), len(x)) - 1] * max(span / len(x), 1.0)
    u = np.clip(distance / np.maximum(reach, 1e-12)[:, None], 0, 1)
    w = (1 - u**3) ** 3 * weights
    total = np.maximum(w.sum(axis=1), 1e-12)
    mean = (w * y).sum(axis=1) / total
    if degree == 0:
        return mean
    mx = (w * x).sum(axis=1) / total
    dx = x[None, :] - mx[:, None]
    sxx = (w * dx**2).sum(axis=1)
    slope = np.where(sxx > 1e-9, (w * dx * y).sum(axis=1) / np.maximum(sxx, 1e-9), 0.0)
    return mean + slope * (at - mx)


def _moving_mean(y: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(y, np.ones(width) / width, mode="valid")


def stl(y, period, s_window, t_window, s_degree, robust=True):
    """Seasonal and trend parts by the loess procedure of Cleveland et al. (1990)."""
    n = len(y)
    x = np.arange(n, dtype=float)
    low_window = period + (period + 1) % 2
    trend, season, weights = np.zeros(n), np.zeros(n), None
    for _ in range(15 if robust else 1):
        for _ in range(1 if robust else 2):
            detrended = y - trend
            cycle = np.empty(n + 2 * period)
            for phase in range(period):
                xs = x[phase::period]
                at = np.concatenate([[xs[0] - period], xs, [xs[-1] + period]])
                w = None if weights is None else weights[phase::period]
                k = np.arange(-1, len(xs) + 1, dtype=float)
                cycle[at.astype(int) + period] = loess(
                    k[1:-1], detrended[phase::period], k, s_window, s_degree, w
                )
            smooth = _moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3)
            season = cycle[period : period + n] - loess(x, smooth, x, low_window, 1)
            trend = loess(x, y - season, x, t_window, 1, weights)
        if robust:
            rest = np.abs(y - season - trend)
            scale = 6 * np.median(rest)
            if scale <= 0:
                break
            weights = np.maximum((1 - np.clip(rest / scale, 0, 1) ** 2) ** 2, 1e-6)
    return trend, season
